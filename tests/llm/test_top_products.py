"""Top products against brute force: lengths that differ, groups of copies, odd rows, and both ways of pruning."""

import math
import random

import numpy as np
import pytest

from bugloom.llm import top_products
from bugloom.llm.top_products import Best, Block, packed, rows_of, scan

KIND = "vec_id long, embedding array<double>"
ENDS = -(1 << 63), (1 << 63) - 1


def expected(rows, every, k, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is not None and i % every == 0:
            scores = [(-min(max(sum(x * y for x, y in zip(q, p)), ENDS[0]), ENDS[1]), j is None, j or 0) for b, (j, p) in enumerate(kept) if b != a]
            out += [(i, n + 1, None if null else j, -s) for n, (s, null, j) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def taken(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()), key=str)


def clusters(sigma):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 12))
    x = centres[rng.integers(0, 40, 900)] + 0.05 * rng.normal(size=(900, 12))
    x *= np.exp(rng.normal(0, sigma, (900, 1)))
    x[::3] = x[0] * 0.2
    return [(i, [float(v) for v in r]) for i, r in enumerate(x)]


@pytest.fixture(scope="module")
def spread():
    """Lengths over two orders of magnitude, clusters, a third of all rows alike."""
    return clusters(1)


@pytest.mark.parametrize("every", [1, 7])
def test_spread(spark, spread, every, monkeypatch):
    for k, v in (("BUCKET", 64), ("BLOCK", 40), ("DEALT", 3)):
        monkeypatch.setattr(top_products, k, v)
    df = spark.createDataFrame(spread, KIND).repartition(5).selectExpr("*", "'c' AS row", "'c' AS v", "'c' AS bound", "'c' AS j")
    assert taken(top_products.top_products(df, "vec_id", "embedding", every, 10)) == expected(spread, every, 10)


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(rng.choice([3, 3, 3, 2, 5]))]) for i in range(60)]
    rows += [(0, None), (5, [1.0, None, 1.0]), (10, [float("nan"), 1.0, 1.0]), (15, [float("inf")] * 3), (20, []), (25, [0.0] * 3), (30, [-1.0] * 3), (None, [1.0] * 3), (None, [1.0] * 3), (5, [1.0] * 3), (5, [1.0] * 3), (-5, [0.5] * 3)]
    assert taken(top_products.top_products(spark.createDataFrame(rows, KIND), "vec_id", "embedding", 5, 10)) == expected(rows, 5, 10)


def test_products_beyond_floats_and_longs(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(0, 2.0 ** rng.choice([3, 20, 33]))] + [rng.uniform(-(2.0**30), 2.0**30) for _ in range(3)]) for i in range(80)]
    rows += [(80, [1e30, 1.0]), (81, [-1e30, 3.0]), (82, [1e300, 1e300])]
    assert taken(top_products.top_products(spark.createDataFrame(rows, KIND), "vec_id", "embedding", 4, 6)) == expected(rows, 4, 6)


def test_few_rows_and_none(spark):
    assert taken(top_products.top_products(spark.createDataFrame([(100, [1.0]), (1, [2.0])], KIND), "vec_id", "embedding")) == [(100, 1, 1, 1024 * 2048)]
    assert taken(top_products.top_products(spark.createDataFrame([(100, [1.0])], KIND), "vec_id", "embedding")) == []
    assert taken(top_products.top_products(spark.createDataFrame([], KIND), "vec_id", "embedding")) == []


def test_buckets_prune_by_length_and_by_coordinate(spark):
    rows = rows_of(spark.createDataFrame(clusters(0.2), KIND).coalesce(1), "vec_id", "embedding", 1024)
    from pyspark.sql import functions as F

    buckets = packed(rows.withColumn("bound", F.lit(float("-inf"))).coalesce(1).sortWithinPartitions(F.desc("length")), 128).toArrow().to_batches()
    blocks = [Block(b, i, "") for b in buckets for i in range(b.num_rows)]
    best = Best(blocks[0], 3)
    told = [scan(best, b) for b in blocks]
    assert told[0]["length"] and sum(t["coordinate"] for t in told) and told[-1]["pruned"] > told[1]["pruned"]
    q, v = blocks[0].v.astype(int), np.concatenate([b.v for b in blocks]).astype(int)
    products = q @ v.T
    names = np.concatenate([b.rows for b in blocks])
    products[blocks[0].rows[:, None] == names] = -(1 << 60)
    top = -np.sort(-products, axis=1)[:, :3]
    for i in range(len(q)):
        assert sorted(best.score[best.query == i])[::-1] == list(top[i])
