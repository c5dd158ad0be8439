"""Shared plumbing: scratch tables in the shared folder, Arrow text buffers, hashing of words."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: ASCII white space that separates words: space and \t \n \v \f \r.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir; a temporary one only in local mode."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = "file://" + tempfile.mkdtemp(prefix="bugloom-")
    spark.conf.set("spark.checkpoint.dir", at)
    return at


def table(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, light: bool = False) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back; this cuts lineage.  light: it shuffled little."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if not light:
        freed(spark)
    return out


def dropped(*frames: DataFrame) -> None:
    """Deletes scratch tables that nothing will read again."""
    for df in frames:
        if path := getattr(df, "_scratch", None):
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of finished jobs."""
    gc.collect()
    spark._jvm.System.gc()


#: Rows that a Python worker gets at once: bounds its memory where texts are long.
BATCH_ROWS = 1000


def mapped(df: DataFrame, f, schema) -> DataFrame:
    """df.mapInArrow in small batches."""
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(f, schema)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty texts; offsets start at 0."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    if len(arr) == 0 or arr.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[offs[0] : offs[-1]]
    return data, offs - offs[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


class Kept:
    """What a process has worked out once; it travels empty to other processes."""

    def __init__(self) -> None:
        self.tables: tuple[np.ndarray, ...] = ()

    def __reduce__(self):
        return Kept, ()


_BASE = U64(0x9E3779B97F4A7C15 | 1)
_POWERS = Kept()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if not _POWERS.tables or len(_POWERS.tables[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        p = np.full(size, _BASE, U64)
        p[0] = 1
        q = np.full(size, U64(pow(int(_BASE), -1, 1 << 64)), U64)
        q[0] = 1
        _POWERS.tables = np.cumprod(p, dtype=U64), np.cumprod(q, dtype=U64)
    return _POWERS.tables[0][:n], _POWERS.tables[1][:n]


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = polynomial hash of symbols[i:j] times base^i."""
    out = np.zeros(len(symbols) + 1, U64)
    np.cumsum(symbols * powers(len(symbols))[0], out=out[1:])
    return out


def range_hash(sums: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """64-bit hashes of symbols[i:j], alike wherever the symbols stand."""
    return mix((sums[j] - sums[i]) * powers(len(sums))[1][i])


_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0xA24BAED4963EE407))


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, bounds): byte ranges of the words and, for each text, where its words begin; bounds has one more."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    solid = ~_IS_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    begin = np.flatnonzero(solid & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | first[1:])) + 1
    return begin, end, np.searchsorted(begin, offs)


def word_symbols(data: np.ndarray, begin: np.ndarray, end: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash for each word."""
    out, i = np.empty(len(begin), U64), 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + block, "right")))
        base = begin[i]
        sums = prefix_sums(byte_symbols(data[base : end[j - 1]]))
        out[i:j] = range_hash(sums, begin[i:j] - base, end[i:j] - base)
        i = j
    return out


def in_runs(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of lengths, one after another."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
