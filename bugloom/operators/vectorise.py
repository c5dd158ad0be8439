"""TF-IDF vectors, centroids, nearest neighbours, a two-dimensional view."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine, doubles

CODE_TOKEN = r"[A-Za-z_][A-Za-z0-9_]+|[+\-=!<>]+"
#: Bytes of centroids up to which they are shipped to every task; beyond it assignment goes in blocks of them.
SHIPPED = 64 << 20
#: Vectors of a block of which products are worked out at once.
BLOCK = 1024


def _runs(size: Column, n: int, run) -> Column:
    """run(place) for each of the size - n + 1 places, counted from 1."""
    return F.transform(F.sequence(F.lit(1), size - (n - 1)), run)


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of low to high tokens, joined by a space."""

    def of(n: int) -> Column:
        runs = _runs(F.size(tokens), n, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of, range(low, high + 1)))


def char_ngrams(text: Column, low: int, high: int) -> Column:
    """Runs of characters within words that are padded with a space at both ends; a shorter word is one run."""
    padded = F.transform(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of(n: int) -> Column:
        def word(w: Column) -> Column:
            return F.when(F.length(w) >= n, _runs(F.length(w), n, lambda i: F.substring(w, i, F.lit(n)))).otherwise(F.array(w))

        return F.flatten(F.transform(padded, word))

    return F.concat(*map(of, range(low, high + 1)))


def code_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({CODE_TOKEN})"), 1)


def tfidf(docs: DataFrame, terms: Column, max_features: int | None = None, min_df: int = 1, sublinear: bool = True) -> DataFrame:
    """id, term, weight: (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), of length 1 for each id.

    docs: id.  Kept terms stand in min_df documents; beyond max_features the most frequent count, of equal ones the first
    in order.  Terms are taken from texts and shuffled once, for the vocabulary and for the weights: both read the same
    counts, so neither may filter them otherwise (null terms go here).
    """
    n = docs.count()
    tf = docs.select("id", F.explode(terms).alias("term")).filter("term IS NOT NULL").groupBy("id", "term").agg(F.count("*").alias("tf"))
    vocabulary = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).filter(F.col("df") >= min_df)
    if max_features:
        vocabulary = vocabulary.orderBy(F.desc("total"), "term").limit(max_features)
        vocabulary = F.broadcast(vocabulary)
    weight = ((1 + F.log("tf")) if sublinear else F.col("tf")) * (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)
    rows = tf.join(vocabulary, "term").select("id", "term", weight.alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return rows.withColumn("length", length).select("id", "term", (F.col("w") / F.col("length")).alias("weight"))


def hashed(docs: DataFrame, terms: Column, dims: int = 256) -> DataFrame:
    """id, vector: terms hashed into `dims` places with signs, (1 + ln tf) each, of length 1; no vocabulary and no model.

    A text without terms has no vector.  docs: id.  The place and the sign come from the md5 of the term, so that vectors
    of any run, machine or engine can be compared.  Two different terms of one place add up or cancel: with signs the
    expected product of two texts is that of their terms.
    """
    tf = docs.select("id", F.explode(terms).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    digest = F.md5(F.col("term").cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    signed = F.when(part(9) % 2 == 0, 1.0).otherwise(-1.0) * (1 + F.log("tf"))
    places = tf.groupBy("id", (part(1) % dims).cast("int").alias("place")).agg(F.sum(signed).alias("x"))
    packed = places.groupBy("id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"), F.map_from_entries(F.collect_list(F.struct("place", "x"))).alias("m"))
    at = F.sequence(F.lit(0), F.lit(dims - 1))
    return packed.filter("length > 0").select("id", F.transform(at, lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0.0)) / F.col("length")).alias("vector"))


def tfidf_blocks(docs: DataFrame, word_terms: Column, char_terms: Column) -> DataFrame:
    """Words and characters side by side, each block of length 1, then the whole."""
    words = tfidf(docs, word_terms, 8192, 3).withColumn("term", F.concat(F.lit("w:"), "term"))
    chars = tfidf(docs, char_terms, 4096, 3).withColumn("term", F.concat(F.lit("c:"), "term"))
    rows = words.unionByName(chars)
    length = rows.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    return rows.join(length, "id").select("id", "term", (F.col("weight") / F.col("length")).alias("weight"))


def centroids(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key, centroid, size: means by place; noise (-1) and unclustered rows go."""
    rows = vectors.filter(F.col(key) >= 0).select(key, F.posexplode(doubles(F.col(vector))).alias("pos", "x"))
    means = rows.groupBy(key, "pos").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    out = means.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("c"), F.max("n").alias("size"))
    return out.select(key, F.transform("c", lambda v: v["x"]).alias("centroid"), "size")


def nearest(vectors: DataFrame, cents: DataFrame, key: str, threshold: float) -> DataFrame:
    """vectors with the cluster of the most similar centroid (ties: the least key) and the cosine; null below threshold.

    vectors: id, vector; cents: key, centroid.  Centroids are shipped to tasks while they are small, else vectors meet
    them in blocks, each of which keeps its best only.
    """
    dim = cents.select(F.max(F.size("centroid")), F.count("*")).first()
    size = 8 * (dim[0] or 0) * dim[1]
    c = cents.select(F.col(key).alias("_k"), "centroid")
    blocks = max(1, math.ceil(size / SHIPPED))
    best = None
    for b in range(blocks):
        part = c.filter(F.pmod(F.xxhash64("_k"), F.lit(blocks)) == b) if blocks > 1 else c
        rows = vectors.crossJoin(F.broadcast(part)).withColumn("cos", cosine(F.col("vector"), F.col("centroid")))
        one = rows.groupBy("id").agg(F.max_by("_k", F.struct("cos", -F.col("_k"))).alias("_k"), F.max("cos").alias("cos"))
        best = one if best is None else best.unionByName(one)
    if blocks > 1:
        best = best.groupBy("id").agg(F.max_by("_k", F.struct("cos", -F.col("_k"))).alias("_k"), F.max("cos").alias("cos"))
    return best.select("id", F.when(F.col("cos") >= threshold, F.col("_k")).alias(key), "cos")


def _packed(rows: DataFrame, most: int, copies: int | None = None) -> DataFrame:
    """ids, xs: the rows (id, vector), at most `most` at a time; copies: so many ids at most of equal vectors among them, the least."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), most):
                b = batch.slice(i, most)
                if copies and len(b) > copies:
                    order = pc.sort_indices(b["id"])
                    keys = pd.Series([None if v is None else np.asarray(v).tobytes() for v in b["vector"].take(order).to_numpy(zero_copy_only=False)])
                    b = b.take(order.filter(pa.array((keys.groupby(keys, dropna=False).cumcount() < copies).to_numpy())))
                ends = pa.array([0, len(b)], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, b["id"]), pa.ListArray.from_arrays(ends, b["vector"])], names=["ids", "xs"])

    return rows.select("id", "vector").mapInArrow(of, f"ids array<{rows.schema['id'].dataType.simpleString()}>, xs array<array<double>>")


def _by_length(xs: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each length: the places of vectors without nulls, their matrix and norms."""
    lengths = pc.list_value_length(xs).fill_null(-1).to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(lengths[lengths >= 0]).tolist():
        at = np.flatnonzero(lengths == n)
        flat = xs.take(pa.array(at)).flatten()
        whole = ~flat.is_null().to_numpy(zero_copy_only=False).reshape(len(at), n).any(1)
        x = flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(at), n)[whole]
        out[n] = at[whole], x, np.sqrt(_dots(x, x))
    return out


def _dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of rows, added in order as functions.vectors.dot does."""
    out = np.zeros(len(x))
    for c in range(x.shape[1]):
        out += x[:, c] * y[:, c]
    return out


def _nearest_of(ids: pa.Array, xs: pa.ListArray, asked: pa.Array, qs: pa.ListArray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place of query, place of id, cosine, whether it is null) of the k first ids of each query.

    A matrix product finds those that may be among the first; only their cosines are worked out as functions.vectors does.
    """
    sure, maybe = np.full((len(asked), len(ids)), -np.inf), np.zeros((len(asked), len(ids)), bool)
    vectors, queries = _by_length(xs), _by_length(qs)
    for n in vectors.keys() & queries.keys():
        (i, q, nq), (j, v, nv) = queries[n], vectors[n]
        plain = lambda norm: (norm > 1e-100) & (norm < 1e100)
        a, b = plain(nq), plain(nv)
        maybe[np.ix_(i, j)] = ~(a[:, None] & b)
        sure[np.ix_(i[a], j[b])] = (q[a] / nq[a, None]) @ (v[b] / nv[b, None]).T
    own = np.zeros(sure.shape, bool)
    place = {x: p for p, x in enumerate(ids.to_pylist())}
    for row, x in enumerate(asked.to_pylist()):
        if x in place:
            own[row, place[x]] = True
    sure[own] = -np.inf
    last = np.partition(sure, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) >= k else np.full(len(asked), -np.inf)
    maybe |= (sure >= last[:, None] - 1e-9) | np.isneginf(last)[:, None]
    at, to = np.nonzero(maybe & ~own)
    cos, null = np.zeros(len(at)), np.ones(len(at), bool)
    rows, cols = np.full(len(asked), -1), np.full(len(ids), -1)
    for n in vectors.keys() & queries.keys():
        (i, q, nq), (j, v, nv) = queries[n], vectors[n]
        rows[:], cols[:] = -1, -1
        rows[i], cols[j] = np.arange(len(i)), np.arange(len(j))
        those = np.flatnonzero((rows[at] >= 0) & (cols[to] >= 0))
        for some in np.array_split(those, len(those) // 100_000 + 1):
            r, c = rows[at[some]], cols[to[some]]
            size = nq[r] * nv[c]
            null[some] = size == 0
            cos[some] = np.divide(_dots(q[r], v[c]), size, out=np.zeros(len(some)), where=size != 0)
    rank = np.empty(len(ids), int)
    rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    order = np.lexsort((rank[to], np.where(null, np.inf, np.where(np.isnan(cos), -np.inf, -cos)), at))
    at, to, cos, null = at[order], to[order], cos[order], null[order]
    first = np.arange(len(at)) - np.searchsorted(at, at) < k
    return at[first], to[first], cos[first], null[first]


def knn(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The k most similar other vectors of each query, exactly: blocks of the stated queries, shipped to tasks, against blocks of all vectors.

    Of each two blocks k rows a query are left before rows meet.  queries, vectors: id, vector.
    """
    q = queries.select("id", doubles(F.col("vector")).alias("vector")).filter("id IS NOT NULL")
    v = vectors.select("id", doubles(F.col("vector")).alias("vector")).filter("id IS NOT NULL")
    size = q.agg(F.sum(8 * F.size("vector") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / SHIPPED))
    ids, asked = (df.schema["id"].dataType.simpleString() for df in (v, q))
    packed = _packed(v, BLOCK, k + 1).repartition(max(1, math.ceil(v.count() / (4 * BLOCK))))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(len(batch)):
                one, xs, queried, qs = (batch[c][b].values for c in ("ids", "xs", "asked", "qs"))
                at, to, cos, null = _nearest_of(one, xs, queried, qs, k)
                yield pa.RecordBatch.from_arrays([queried.take(pa.array(at)), one.take(pa.array(to)), pa.array(cos, mask=null)], names=["query", "id", "cos"])

    out = None
    for b in range(blocks):
        part = q.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else q
        pairs = packed.crossJoin(F.broadcast(_packed(part, BLOCK).select(F.col("ids").alias("asked"), F.col("xs").alias("qs"))))
        some = pairs.mapInArrow(of, f"query {asked}, id {ids}, cos double")
        one = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cos"), "id"))).filter(F.col("rank") <= k)
        out = one if out is None else out.unionByName(one)
    return out


def svd_view(docs: DataFrame, terms: Column, features: int = 2000, rounds: int = 12) -> DataFrame:
    """id, x, y: the first two singular directions of TF-IDF vectors, by orthogonal iteration.

    Vectors are packed by id and meet the features where they are: a round shuffles two sums a feature and task; only
    features * 2 numbers are at the driver.
    """
    spark = docs.sparkSession
    rows = tfidf(docs, terms, features, 1).persist()
    names = [r.term for r in rows.select("term").distinct().orderBy("term").collect()]  # at most `features`
    places = F.broadcast(spark.createDataFrame(list(enumerate(names)), "place int, term string"))
    packed = rows.join(places, "term").groupBy("id").agg(F.collect_list(F.struct("place", "weight")).alias("v")).select("id", "v.place", "v.weight").persist()
    rng = np.random.default_rng(42)
    basis = np.linalg.qr(rng.normal(size=(max(len(names), 2), 2)))[0]
    kind = docs.schema["id"].dataType.simpleString()

    def views(batch: pa.RecordBatch, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = pc.list_value_length(batch["place"]).to_numpy(zero_copy_only=False)
        row, place, w = np.repeat(np.arange(len(batch)), sizes), batch["place"].flatten().to_numpy(zero_copy_only=False), batch["weight"].flatten().to_numpy(zero_copy_only=False)
        return np.stack([np.bincount(row, w * b[place, k], len(batch)) for k in (0, 1)], axis=1), row, place, w

    def summed(b: np.ndarray):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(b)
            for batch in filter(len, batches):
                xy, row, place, w = views(batch, b)
                total += np.stack([np.bincount(place, w * xy[row, k], len(b)) for k in (0, 1)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(b), dtype=np.int32)), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["place", "x", "y"])

        return packed.mapInArrow(of, "place int, x double, y double").groupBy("place").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))

    for _ in range(rounds if names else 0):
        new = np.zeros_like(basis)
        for r in summed(basis).collect():
            new[r.place] = r.x, r.y
        basis = np.linalg.qr(new)[0]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            xy = views(batch, basis)[0]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["id", "x", "y"])

    return packed.mapInArrow(projected, f"id {kind}, x double, y double")
