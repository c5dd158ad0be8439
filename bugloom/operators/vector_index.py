"""Inverted lists over vectors: written once by coarse centre, then searched by reading the lists that can hold an answer.

`built` clusters a bounded sample, deals every vector to the list of its nearest centre and writes two Parquet tables:
lists, partitioned by list, and centres with each list's size and the least cosine of a member to its centre.  `search`
reads the lists nearest to each query only (partition pruning), and, if it is to be exact, those others in which the angle
between query and centre, less the widest angle of a member, leaves room for a better answer than the k-th.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles

#: Vectors that centres are learnt from; vectors and queries that meet in one task.
SAMPLE, PART, ASKED = 50_000, 65_536, 16_384
#: Bytes of centres that are shipped to tasks.
SHIPPED = 64 << 20
_LIST = "id long, vector array<double>, list int, cos double"


def _matrix(lists: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, unit vectors) of the rows that have a direction and that many components."""
    at = np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(lists), -1)) == dims)
    x = np.asarray(lists.take(pa.array(at)).flatten().fill_null(np.nan)).astype(np.float64).reshape(len(at), dims)
    with np.errstate(invalid="ignore", divide="ignore"):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
    good = np.isfinite(x).all(axis=1) if dims else np.zeros(len(at), bool)
    return at[good], x[good]


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, max(1, x.shape[1])), pa.int32()) if len(x) else pa.array([0], pa.int32()), pa.array(x.ravel()))


def learnt(vectors: DataFrame, n_lists: int, sample: int = SAMPLE, seed: int = 7, rounds: int = 10) -> np.ndarray:
    """Unit centres from at most `sample` vectors, the first by a hash of their id; fewer if there are fewer directions."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    some = vectors.filter(F.exists("vector", lambda v: v != 0) & ~F.exists("vector", lambda v: F.isnan(v) | (F.abs(v) == float("inf"))) & F.forall("vector", lambda v: v.isNotNull()))
    usual = some.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1)  # one length: of most vectors
    some = some.join(F.broadcast(usual), F.size("vector") == F.col("dims"), "left_semi")
    some = some.orderBy(F.xxhash64("id"), "id").limit(sample).select(array_to_vector(doubles(F.col("vector"))).alias("features")).persist()
    try:
        if not some.head(1):
            return np.zeros((0, 0))
        model = KMeans(k=max(2, n_lists), distanceMeasure="cosine", seed=seed, maxIter=rounds).fit(some)
        centres = np.array(model.clusterCenters(), np.float64)
    finally:
        some.unpersist()
    return centres / np.linalg.norm(centres, axis=1, keepdims=True)


def dealt(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """id, unit vector, list, cos: the nearest centre (the first of equals); rows without a direction are left out."""
    if centres.nbytes > SHIPPED:
        raise ValueError(f"centres of {centres.nbytes} bytes: fewer lists, please")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _matrix(batch.column(1), centres.shape[1])
            if len(centres) and len(x):
                cos = x @ centres.T
                best = cos.argmax(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), _lists(x), pa.array(best.astype(np.int32)), pa.array(np.clip(cos[np.arange(len(x)), best], -1, 1))], ["id", "vector", "list", "cos"])

    return vectors.select(F.col("id").cast("long").alias("id"), doubles(F.col("vector")).alias("vector")).mapInArrow(of, _LIST)


def built(vectors: DataFrame, path: str, n_lists: int, sample: int = SAMPLE) -> None:
    """Writes path/lists and path/centres.  vectors: id, vector."""
    spark = vectors.sparkSession
    centres = learnt(vectors, n_lists, sample)
    rows = dealt(vectors, centres).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int"))
    # a list of many copies goes to as many tasks as any other rows; each opens a file for the lists that it holds
    rows.repartition("list", F.col("part") % 8).write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")
    sizes = lists_at(spark, path).groupBy("list").agg(F.count("*").alias("size"), F.min("cos").alias("widest"))
    table = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "list int, centre array<double>")
    table.join(sizes, "list").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")


def lists_at(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id long, vector array<double>, cos double, part int, list int").parquet(f"{path}/lists")


def _asked(queries: DataFrame, centres: pa.Table, n_probe: int) -> DataFrame:
    """For each query and list: whether it is one of the n_probe nearest, and the best cosine that the list can hold."""
    names, c = np.asarray(centres["list"]), np.stack(centres["centre"].to_numpy()) if len(centres) else np.zeros((0, 0))
    widest = np.arccos(np.clip(np.asarray(centres["widest"]), -1, 1))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _matrix(batch.column(1), c.shape[1])
            for i in range(0, len(x) if len(c) else 0, 256):
                some = x[i : i + 256]
                cos = some @ c.T
                place = np.argsort(np.argsort(-cos, axis=1, kind="stable"), axis=1)
                bound = np.cos(np.maximum(0, np.arccos(np.clip(cos, -1, 1)) - widest)) + 1e-9
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[i : i + 256])).take(pa.array(np.repeat(np.arange(len(some)), len(c)))), _lists(np.repeat(some, len(c), axis=0)), pa.array(np.tile(names, len(some)).astype(np.int32)), pa.array((place < n_probe).ravel()), pa.array(bound.ravel())], ["query", "q", "list", "near", "bound"])

    return queries.select(F.col("id").cast("long").alias("query"), doubles(F.col("vector")).alias("q")).mapInArrow(of, "query long, q array<double>, list int, near boolean, bound double")


def _met(asked: DataFrame, rows: DataFrame, centres: DataFrame, k: int, blocks: int) -> DataFrame:
    """The k best of each query among the rows of its lists; a part of a list meets a block of queries in a task."""
    parts = centres.select("list", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    q = asked.join(F.broadcast(parts), "list").select("query", "q", "list", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    v = rows.join(F.broadcast(parts), "list").select("id", "vector", "list", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), (F.col("part") % F.col("parts")).alias("part"))

    def of(these: pa.Table, those: pa.Table) -> pa.Table:
        if not len(these) or not len(those):
            return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "cos": pa.array([], pa.float64())})
        a, b = (np.asarray(t[c].combine_chunks().flatten()).reshape(len(t), -1) for t, c in ((these, "q"), (those, "vector")))
        names, ids = np.asarray(these["query"]), np.asarray(those["id"])
        out = []
        for i in range(0, len(a), 256):
            cos = np.round(a[i : i + 256] @ b.T, 12)
            cos[names[i : i + 256, None] == ids] = -np.inf
            if len(ids) > k:
                least = np.partition(cos, len(ids) - k, axis=1)[:, len(ids) - k]
            else:
                least = np.full(len(cos), -2.0)
            x, y = np.nonzero((cos >= least[:, None]) & (cos > -np.inf))
            order = np.lexsort((ids[y], -cos[x, y], x))
            x, y = x[order], y[order]
            keep = np.arange(len(x)) - np.searchsorted(x, x) < k
            out.append((names[i + x[keep]], ids[y[keep]], cos[x[keep], y[keep]]))
        return pa.table({n: np.concatenate(c) for n, c in zip(("query", "id", "cos"), zip(*out, strict=True), strict=True)})

    keys = ("list", "block", "part")
    return q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInArrow(of, "query long, id long, cos double")


def search(spark: SparkSession, path: str, queries: DataFrame, k: int, n_probe: int, exact: bool = False) -> DataFrame:
    """query, id, cos, rank: the k most similar other vectors of each query, of equals the least id.

    queries: id, vector.  Only the n_probe nearest lists of each query are read; exact: and those that may hold better.
    """
    table = spark.read.parquet(f"{path}/centres")
    centres = table.toArrow()  # a row for each list
    asked = _asked(queries, centres, n_probe)
    blocks = max(1, math.ceil(queries.count() / ASKED))

    def among(some: DataFrame) -> DataFrame:
        wanted = [r.list for r in some.select("list").distinct().collect()]  # numbers of lists, to read only those
        return _met(some, lists_at(spark, path).filter(F.col("list").isin(wanted)), table, k, blocks)

    order = Window.partitionBy("query").orderBy(F.desc("cos"), "id")
    best = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    near = best(among(asked.filter("near")))
    if exact:
        reached = near.groupBy("query").agg(F.min("cos").alias("least"), F.count("*").alias("n"))
        rest = asked.filter("NOT near").join(reached, "query", "left").filter(F.col("n").isNull() | (F.col("n") < k) | (F.col("bound") >= F.col("least")))
        near = best(near.drop("rank").unionByName(among(rest.select("query", "q", "list"))))
    return near


def recall(found: DataFrame, truth: DataFrame) -> float:
    """The share of the true neighbours that were found.  Both: query, id."""
    n = truth.count()
    return found.select("query", "id").join(truth.select("query", "id"), ["query", "id"], "left_semi").count() / n if n else 1.0
