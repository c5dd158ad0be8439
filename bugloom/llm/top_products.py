"""Exact top-k search by inner product: vectors in buckets of falling length, pruned by length or by one coordinate.

Vectors become integers, are range-partitioned by length and packed into buckets.  Each block of queries first meets the
bucket of the longest vectors; its k-th best product there bounds what can still count.  Then every bucket meets the
blocks of queries that its longest vector can still serve.  In a bucket a query has a local cosine threshold, its bound
over both lengths.  Where that is high, the vectors whose value at the query's largest coordinate lies within the angle
it allows are looked up in sorted order; else those long enough are taken.  Their products are worked out in full, and
the bound rises with every bucket that a task sees.  Buckets stay where they are dealt; only blocks of queries are copied.

Nulls, ties and odd tables: vectors that are null or hold a null, NaN or infinite component take no part; a missing
component counts as 0 where lengths differ, an empty vector's products are 0.  A row is its own candidate nowhere, but
rows that repeat are rows of their own.  Ties go to the smaller id, a null id is the last and never a query.  Products
beyond the range of long count as its nearest end.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import dropped, parts, stored, table

#: Results of a query, the factor before rounding down; queries are the rows whose id is divisible by EVERY.
K, SCALE, EVERY = 10, 1024, 100
#: Vectors of a bucket, of a block of queries, bytes of either at most, buckets of a task.
BUCKET, BLOCK, BYTES, DEALT = 4096, 2048, 1 << 23, 64
#: Coordinates are looked up from this cosine on, if they leave so small a share of the bucket.
COSINE, SHARE = 0.5, 1 / 16

_LAST, _ENDS = np.iinfo(np.int64).max, (np.iinfo(np.int64).min, np.iinfo(np.int64).max)
_BLOCK = "block long, longest double, need double, rows binary, ids binary, nulls binary, lengths binary, bounds binary, dims int, kind string, v binary"
_HIT = "query long, query_id long, row long, vec_id long, score long"


def rows_of(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """row, vec_id, length, v: integers as 64-bit floats, which hold them exactly."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            whole = lists.filter(lists.is_valid())
            flat = whole.flatten()
            x = np.floor(np.asarray(flat.cast(pa.float64()).fill_null(np.nan)) * float(scale))
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(whole)))]).astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            good = np.flatnonzero(bad[ends[1:]] == bad[ends[:-1]])
            squares = np.concatenate([[0.0], np.cumsum(x * x)]) if np.isfinite(x).all() and np.abs(x).max(initial=0) < 1 << 20 else None
            ids = batch.column(0).filter(lists.is_valid()).take(pa.array(good))
            if squares is not None and squares[-1] < 1 << 53:  # whole numbers: differences are exact
                length = np.sqrt(squares[ends[good + 1]] - squares[ends[good]])
            else:
                with np.errstate(over="ignore"):
                    length = np.array([np.hypot.reduce(x[ends[i] : ends[i + 1]], initial=0.0) for i in good], np.float64)
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(length), pa.array([x[ends[i] : ends[i + 1]].tobytes() for i in good], pa.binary())], ["vec_id", "length", "v"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x")).mapInArrow(of, "vec_id long, length double, v binary").withColumn("row", F.monotonically_increasing_id())


def packed(rows: DataFrame, most: int) -> DataFrame:
    """Blocks of rows in their order: matrices in the narrowest exact type; need: the least length that can still serve one."""

    def block(at: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        vectors = [np.frombuffer(x.as_buffer(), np.float64) for x in t["v"]]
        dims = max((len(x) for x in vectors), default=0)
        m = np.zeros((len(vectors), dims))
        for i, x in enumerate(vectors):
            m[i, : len(x)] = x
        top = np.abs(m).max(initial=0)
        kind = "i2" if top < 1 << 15 else "i4" if top < 1 << 31 else "f8"
        length, bound, ids = np.asarray(t["length"]), np.asarray(t["bound"]), t["vec_id"]
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(bound > 0, bound / length, -np.inf)
        cells = [at, float(length.max(initial=0)), float(need.min(initial=np.inf)), np.asarray(t["row"]).tobytes(), np.asarray(pc.fill_null(ids, _LAST)).tobytes(), np.asarray(pc.is_null(ids)).tobytes(), length.tobytes(), bound.tobytes(), dims, kind, m.astype(kind).tobytes()]
        return pa.RecordBatch.from_pydict({n.split()[0]: [c] for n, c in zip(_BLOCK.split(", "), cells, strict=True)}, schema=pa.schema([("block", pa.int64()), ("longest", pa.float64()), ("need", pa.float64()), *((c, pa.binary()) for c in ("rows", "ids", "nulls", "lengths", "bounds")), ("dims", pa.int32()), ("kind", pa.string()), ("v", pa.binary())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, count, widest = TaskContext.get().partitionId(), 0, [], 0, 8
        for batch in batches:
            size = np.maximum(np.asarray(pc.binary_length(batch.column("v"))), 8)
            i = 0
            while i < batch.num_rows:
                wide = np.maximum(np.maximum.accumulate(size[i:]), widest)
                fits = (count + np.arange(1, len(wide) + 1) <= most) & (wide * (count + np.arange(1, len(wide) + 1)) <= BYTES)
                k = len(fits) if fits.all() else int(np.argmin(fits))
                if not k and not count:
                    k = 1  # a vector that is longer than a block
                if k:
                    held.append(batch.slice(i, k))
                    count, widest, i = count + k, int(wide[k - 1]), i + k
                if i < batch.num_rows or count >= most:
                    yield block((task << 32) + n, held)
                    n, held, count, widest = n + 1, [], 0, 8
        if count:
            yield block((task << 32) + n, held)

    return rows.select("row", "vec_id", "length", "bound", "v").mapInArrow(of, _BLOCK)


class Block:
    """A packed block as arrays."""

    def __init__(self, batch: pa.RecordBatch, i: int, prefix: str) -> None:
        read = lambda name, kind: np.frombuffer(batch.column(prefix + name)[i].as_buffer(), kind)
        self.name = batch.column(prefix + "block")[i].as_py()
        self.rows, self.ids, self.nulls = read("rows", np.int64), read("ids", np.int64), read("nulls", bool)
        self.lengths, self.bounds = read("lengths", np.float64), read("bounds", np.float64)
        self.v = read("v", batch.column(prefix + "kind")[i].as_py()).reshape(len(self.rows), batch.column(prefix + "dims")[i].as_py())
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def by_coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of unit vectors at a coordinate in order, and whose they are."""
        if f not in self.sorted:
            with np.errstate(invalid="ignore", divide="ignore"):
                x = np.nan_to_num(self.v[:, f] / self.lengths)
            order = np.argsort(x, kind="stable")
            self.sorted[f] = x[order], order
        return self.sorted[f]


class Best:
    """The k best products of each query of a block, as far as a task has seen."""

    def __init__(self, block: Block, k: int) -> None:
        self.block, self.k = block, k
        self.query, self.score, self.nulls, self.ids, self.rows = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64))
        self.bound = block.bounds.copy()

    def add(self, query: np.ndarray, score: np.ndarray, of: Block, at: np.ndarray) -> None:
        own = of.rows[at] == self.block.rows[query]
        query, score, at = query[~own], score[~own], at[~own]
        if not len(query):
            return
        q, s, n, i, r = np.append(self.query, query), np.append(self.score, score), np.append(self.nulls, of.nulls[at]), np.append(self.ids, of.ids[at]), np.append(self.rows, of.rows[at])
        order = np.lexsort((r, i, n, ~s, q))  # ~s falls as s rises
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        order, q, place = order[place < self.k], q[place < self.k], place[place < self.k]
        self.query, self.score, self.nulls, self.ids, self.rows = q, s[order], n[order], i[order], r[order]
        last = np.flatnonzero(place == self.k - 1)
        self.bound[q[last]] = np.maximum(self.bound[q[last]], np.nextafter(self.score[last].astype(np.float64), -np.inf) if len(last) and np.abs(self.score[last]).max() >= 1 << 53 else self.score[last])

    def out(self) -> pa.RecordBatch:
        ids = pa.array(self.ids, mask=self.nulls)
        return pa.RecordBatch.from_arrays([pa.array(self.block.rows[self.query]), pa.array(self.block.ids[self.query]), pa.array(self.rows), ids, pa.array(self.score)], ["query", "query_id", "row", "vec_id", "score"])


def _exact(q: np.ndarray, p: np.ndarray) -> int:
    """A product of any size, within the range of long."""
    return min(max(sum(int(a) * int(b) for a, b in zip(q, p, strict=True)), _ENDS[0]), _ENDS[1])


def scan(best: Best, bucket: Block, chunk: int = 256) -> dict[str, int]:
    """Adds to best what a bucket holds; tells how many queries were pruned, looked up by coordinate or met by length."""
    block, told = best.block, {"pruned": 0, "coordinate": 0, "length": 0}
    dims = min(block.v.shape[1], bucket.v.shape[1])
    longest = float(bucket.lengths.max(initial=0))
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        reach = block.lengths * longest
        top = float(reach.max(initial=0))
        kind = np.float32 if top < 1 << 24 else np.float64
        slack = 0.0 if top < 1 << 53 else max(dims, 1) * 2.0**-48 * top  # whole numbers under 2^53 add up exactly
        local = np.where(best.bound > 0, best.bound / reach * (1 - 1e-9), -1.0)  # a query's cosine threshold here
        local[np.isnan(local)] = np.where(best.bound[np.isnan(local)] > 0, np.inf, -1.0)
    alive = np.flatnonzero((local <= 1) | bool(slack))
    told["pruned"] = len(block.rows) - len(alive)
    q, p = block.v[:, :dims], bucket.v[:, :dims]
    if not slack and dims:
        for f, those in _focused(q, block.lengths, alive[local[alive] >= COSINE]):
            x, order = bucket.by_coordinate(f)
            angle, width = np.arccos(np.clip(q[those, f] / block.lengths[those], -1, 1)), np.arccos(np.clip(local[those], -1, 1))
            low = np.searchsorted(x, np.cos(np.minimum(np.pi, angle + width)) - 1e-9)
            high = np.searchsorted(x, np.cos(np.maximum(0, angle - width)) + 1e-9, "right")
            few = high - low <= SHARE * len(x)
            for i, a, b in zip(those[few], low[few], high[few], strict=True):
                at = order[a:b]
                score = (p[at].astype(kind) @ q[i].astype(kind)).astype(np.float64)
                keep = score >= best.bound[i]
                best.add(np.full(int(keep.sum()), i), score[keep].astype(np.int64), bucket, at[keep])
            told["coordinate"] += int(few.sum())
            alive = np.setdiff1d(alive, those[few], assume_unique=True)
    told["length"] = len(alive)
    alive = alive[np.argsort(local[alive], kind="stable")]
    p_wide = p.astype(kind)
    for i in range(0, len(alive), chunk):
        some = alive[i : i + chunk]
        with np.errstate(over="ignore", invalid="ignore"):
            least = np.where(best.bound[some] > 0, best.bound[some] / block.lengths[some] * (1 - 1e-9), 0).min() if not slack else 0
            far = len(bucket.lengths) - int(np.searchsorted(bucket.lengths[::-1], least, "left"))  # lengths fall
            s = q[some].astype(kind) @ p_wide[:far].T
            bound = best.bound[some]
            if s.shape[1] > best.k:  # the query itself may be one of k + 1
                bound = np.maximum(bound, np.partition(np.nan_to_num(s, nan=-np.inf), s.shape[1] - best.k - 1, axis=1)[:, s.shape[1] - best.k - 1] - 2 * slack)
            a, b = np.nonzero(~(s < (bound - slack)[:, None]))
        score = s[a, b].astype(np.int64) if not slack else np.array([_exact(q[some[x]], p[y]) for x, y in zip(a, b, strict=True)], np.int64)
        best.add(some[a], score, bucket, b)
    return told


def _focused(q: np.ndarray, lengths: np.ndarray, those: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Queries by their largest coordinate, the one that an angle narrows most."""
    if len(those):
        focus = np.abs(q[those]).argmax(axis=1)
        for f in np.unique(focus):
            yield int(f), those[(focus == f) & (lengths[those] > 0)]


def met(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of each query among the buckets that follow each other with one block of queries."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for i in range(batch.num_rows):
                if best is None or best.block.name != batch.column("q_block")[i].as_py():
                    if best is not None:
                        yield best.out()
                    best = Best(Block(batch, i, "q_"), k)
                scan(best, Block(batch, i, ""))
        if best is not None:
            yield best.out()

    return pairs.mapInArrow(of, _HIT)


def _sides(queries: DataFrame, buckets: DataFrame, j) -> tuple[DataFrame, DataFrame]:
    named = queries.select(*(F.col(c).alias(f"q_{c}") for c in queries.columns))
    return named.withColumn("j", j), buckets


def top_products(vectors: DataFrame, id_col: str, vec_col: str, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest products of each row whose id is divisible by `every` with all other rows."""
    spark = vectors.sparkSession
    rows = stored(rows_of(vectors, id_col, vec_col, scale), "op12-rows", light=True)
    n = rows.count()
    some = parts(spark)
    cut = lambda df, n, *by: df.repartitionByRange(max(1, n), *by).sortWithinPartitions(*by)
    falling = [F.desc("length"), F.col("row")]
    buckets = stored(packed(cut(rows.withColumn("bound", F.lit(float("-inf"))), min(n // (4 * BUCKET) + 1, 4 * some), *falling), BUCKET), "op12-buckets")
    asked = rows.filter((F.col("vec_id") % every) == 0)
    seen = buckets.agg(F.max_by("block", F.struct("longest", -F.col("block"))).alias("block"))  # one number
    first = buckets.join(F.broadcast(seen), "block", "left_semi").withColumn("j", F.lit(0))  # one bucket
    blocks = packed(cut(asked.withColumn("bound", F.lit(float("-inf"))), some, "row"), BLOCK)
    left, right = _sides(blocks, first, F.lit(0))
    seeds = stored(met(left.join(F.broadcast(right), "j"), k), "op12-seeds")
    bounds = seeds.groupBy(F.col("query").alias("row")).agg(F.count("*").alias("n"), F.min("score").alias("least")).select("row", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("bound"))
    asked = asked.join(bounds, "row", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf")))).withColumn("need", F.try_divide("bound", "length"))
    blocks = stored(packed(cut(asked, some, "need", "row"), BLOCK), "op12-queries")
    n_buckets = buckets.count()
    keys = max(1, min(n_buckets, max(some, n_buckets // DEALT)))
    rest = buckets.join(F.broadcast(seen), "block", "left_anti").withColumn("j", F.pmod(F.shiftright("block", 32) + F.col("block").bitwiseAND((1 << 32) - 1), F.lit(keys)).cast("int"))
    left, right = _sides(blocks, rest, F.explode(F.sequence(F.lit(0), F.lit(keys - 1))))
    pairs = left.repartition(keys, "j").join(right.repartition(keys, "j").hint("merge"), "j").filter(F.col("longest") >= F.col("q_need") * (1 - 1e-9))
    hits = stored(met(pairs, k), "op12-hits")
    best = hits.unionByName(seeds).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row"))).filter(F.col("rank") <= k)
    out = stored(best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "op12-out")
    dropped(rows, buckets, seeds, blocks, hits)
    return out


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten greatest integer products of each hundredth vector of `embeddings`."""
    return top_products(table(spark, "embeddings", sf_dir), "vec_id", "embedding")


OP12_SQL = f"""WITH v AS (SELECT row_number() OVER () AS r, vec_id, embedding, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0), c AS MATERIALIZED (SELECT r, vec_id, e FROM v),
  s AS (SELECT q.r AS q, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum([z[1] * z[2] for z in list_zip(q.e, c.e) if z[1] IS NOT NULL AND z[2] IS NOT NULL]), 0) AS BIGINT) AS score FROM c AS q JOIN c ON q.r <> c.r WHERE q.vec_id % {EVERY} = 0)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= {K}"""
