"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

1. Content-sampled spans (spans.py) of every text; one short row each is shuffled, and spans whose core is unique end here.
2. The bytes of all other spans go to shards, in which all that may hold equal windows meet.  A shard takes its pieces in
   batches: each batch gets a suffix array of its window starts, whose common prefixes with its neighbours tell the matches
   within the batch, and is merge-scanned against the arrays of earlier levels for matches of the full length; arrays of
   equal rank then merge, so a shard holds logarithmically many.  A piece that many places hold stands in the arrays twice.
3. Each document's repeated windows become byte ranges, which are cut out of it.

The arrays order suffixes by their first LENGTH bytes, as longer matches consist of such.  They live as long as their
shard's task: a lost one is built anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, in_runs, mapped, stored, table, text_buffers
from .spans import Shard, keyed, pieces, runs_in, shared_only, spans

LENGTH = 200
CORE = 32
#: Kinds of spans of one core beyond which its windows are dealt out one by one, and spans in a shard.
HOT_CORE = 5_000
SHARD = 3_000
BATCH = 500

RANGES = "rid long, begin long, stop long"


def common_prefixes(ordered: np.ndarray) -> np.ndarray:
    """How many bytes each suffix but the first shares with the one before it; ordered: fixed-length byte strings."""
    size = ordered.dtype.itemsize
    x = ordered.view(np.uint8).reshape(len(ordered), size)
    out = np.empty(max(len(x) - 1, 0), np.int64)
    for i in range(0, len(out), 1 << 14):
        differ = x[i + 1 : i + 1 + (1 << 14)] != x[i : i + (1 << 14)][: len(x) - 1 - i]
        out[i : i + len(differ)] = np.where(differ.any(1), differ.argmax(1), size)
    return out


class SuffixFamily:
    """Suffix arrays of window starts in levels of geometric size.

    add() takes windows as fixed-length byte strings with their numbers, in any order, and returns the numbers of those
    that occur before: pairs (of the batch, of earlier ones).  A level keeps one entry for each different window.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # rank, sorted windows, number of the first holder

    def add(self, windows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Numbers, new and old, of windows found to repeat."""
        order = np.argsort(windows, kind="stable")
        keys, numbers = windows[order], numbers[order]
        same = np.zeros(len(keys), bool)
        same[1:] = common_prefixes(keys) == keys.dtype.itemsize
        repeated = same.copy()
        repeated[:-1] |= same[1:]
        hits = [numbers[repeated]]
        every, group = numbers, np.cumsum(~same) - 1
        keys, firsts = keys[~same], numbers[~same]
        for _, old, holders in self.levels:
            at = np.searchsorted(old, keys)
            match = (at < len(old)) & (old[np.minimum(at, len(old) - 1)] == keys)
            hits += [every[match[group]], holders[at[match]]]
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, old, holders = self.levels.pop()
            at = np.searchsorted(old, keys)
            fresh = ~((at < len(old)) & (old[np.minimum(at, len(old) - 1)] == keys))
            keys, firsts = np.insert(old, at[fresh], keys[fresh]), np.insert(holders, at[fresh], firsts[fresh])
            rank += 1
        self.levels.append((rank, keys, firsts))
        return np.concatenate(hits)


def repeated_windows(texts: list[bytes], counts: np.ndarray, length: int, marks: np.ndarray | None = None, batch: int = BATCH) -> np.ndarray:
    """For each text's first counts windows, laid end to end, whether the string stands elsewhere in texts of its mark."""
    flags, first = np.zeros(int(counts.sum()), bool), np.concatenate([[0], np.cumsum(counts)])
    marks = np.zeros(len(texts), np.int64) if marks is None else marks
    family = SuffixFamily()
    for i in range(0, len(texts), batch):
        some = texts[i : i + batch]
        data = np.frombuffer(b"".join(some), np.uint8)
        at = np.cumsum([0, *map(len, some[:-1])])
        n = counts[i : i + batch]
        where = np.repeat(at, n) + in_runs(n)
        windows = np.empty((len(where), length + 8), np.uint8)
        windows[:, :length] = np.lib.stride_tricks.sliding_window_view(data, length)[where]
        windows[:, length:] = np.repeat(marks[i : i + batch], n).view(np.uint8).reshape(-1, 8)
        flags[family.add(windows.view(f"S{length + 8}").ravel(), np.arange(first[i], first[i + len(some)]))] = True
    return flags


def repeated_ranges(docs: DataFrame, length: int = LENGTH, core: int = CORE, hot: int = HOT_CORE, shard: int = SHARD) -> DataFrame:
    """RANGES of the byte windows (starts begin to stop - 1) of docs (of keyed()) that stand elsewhere too, stored."""
    sampled = stored(spans(docs, length, core, "bytes").drop("doc_id"), "op4-spans")
    shared = shared_only(sampled)
    dropped(sampled)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shard(batches, by_shard=True)
        if not len(s.entry):
            return
        often = np.bincount(s.entry, s.times * s.how_many, len(s.pieces)) > 1
        texts = [*s.pieces, *(p for p, o in zip(s.pieces, often.tolist(), strict=True) if o)]
        again = np.flatnonzero(often)
        flags = repeated_windows(texts, np.append(s.n, s.n[again]), length, np.append(s.shards, s.shards[again]))[: int(s.n.sum())]
        found = np.flatnonzero(flags)
        row, start, _ = s.occurrences()
        yield s.ranges(row, start, *runs_in(np.repeat(np.arange(len(s.n)), s.n)[found], in_runs(s.n)[found], len(s.n)))

    dealt = pieces(docs, shared, length, "bytes", hot, shard)
    found = stored(mapped(dealt, search, RANGES), "op4-ranges")
    dropped(dealt)
    return found


def covered(begin: np.ndarray, stop: np.ndarray, length: int) -> np.ndarray:
    """Maximal covered runs, as rows (from, to), of windows that start at begin..stop - 1."""
    order = np.argsort(begin, kind="stable")
    b, e = begin[order], np.maximum.accumulate(stop[order] + length - 1)
    new = np.ones(len(b), bool)
    new[1:] = b[1:] > e[:-1]
    first = np.flatnonzero(new)
    return np.stack([b[first], e[np.append(first[1:], len(b)) - 1]], axis=1)


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text, begins and stops of the byte windows to remove (null: none)."""
    docs = keyed(docs)
    lists = repeated_ranges(docs, length).groupBy("rid").agg(F.collect_list("begin").alias("begins"), F.collect_list("stop").alias("stops"))
    return docs.join(lists.hint("merge"), "rid", "left").select("doc_id", "text", "begins", "stops")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without each byte that a 200-byte string found elsewhere covers.

    Null and empty texts: 0 bytes, nothing removed; texts under 200 bytes stay whole; a row that repeats another of 200
    bytes or more is removed whole, like it; further columns are ignored.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            lists = [x.values.to_numpy(zero_copy_only=False) for x in (batch.column(2), batch.column(3))]
            edges = np.concatenate([batch.column(2).offsets.to_numpy()])
            valid = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            removed, count, sha = [], [], []
            for i in range(batch.num_rows):
                text = memoryview(data[offs[i] : offs[i + 1]])
                h = hashlib.sha256()
                if not valid[i]:
                    h.update(text)
                    removed.append(0), count.append(0)
                else:
                    runs = covered(lists[0][edges[i] : edges[i + 1]], lists[1][edges[i] : edges[i + 1]], LENGTH)
                    last = 0
                    for b, e in runs.tolist():
                        h.update(text[last:b])
                        last = e
                    h.update(text[last:])
                    removed.append(int((runs[:, 1] - runs[:, 0]).sum())), count.append(len(runs))
                sha.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return mapped(cleaned(table(spark, "documents", sf_dir)), digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
