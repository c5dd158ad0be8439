"""Density clustering by pairs of blocks gives the labels of the whole, whatever the blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bugloom.operators import hdbscan


def group_of(seed, n, copies=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(4, 5))[rng.integers(0, 4, n)] + 0.1 * rng.normal(size=(n, 5))
    if copies:
        x[::3] = x[0]  # a third alike
        x[1::3] = np.round(x[1::3], 1)  # many equal distances
    return x


@pytest.fixture(scope="module")
def groups():
    return {"a": group_of(1, 150), "b": group_of(2, 90, copies=True), None: group_of(3, 40), "one": group_of(4, 1), "few": group_of(5, 3)}


@pytest.fixture(scope="module")
def table(spark, groups):
    rows = [(g, 1000 * k + 7 * i, [float(v) for v in x]) for k, (g, xs) in enumerate(groups.items()) for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "g string, id long, vector array<double>").repartition(3)


@pytest.mark.parametrize(("block", "fan", "leaf"), [(4096, 8, True), (20, 2, True), (7, 8, False)])
def test_blocks_do_not_matter(table, groups, block, fan, leaf, monkeypatch):
    monkeypatch.setattr(hdbscan, "FAN", fan)
    got = {(r.g, r.id): r.label for r in hdbscan.clustered(table, ["g"], 5, 3, leaf, block).collect()}
    want = {(g, 1000 * k + 7 * i): int(v) for k, (g, xs) in enumerate(groups.items()) for i, v in enumerate(hdbscan.labels_of(xs, 5, 3, leaf))}
    assert got == want and len({v for (g, _), v in got.items() if g == "a"} - {-1}) >= 2


def test_least_forest_is_of_the_order():
    a, b, w = np.array([1, 1, 2, 1]), np.array([2, 3, 3, 4]), np.array([1.0, 1.0, 1.0, 0.5])
    assert hdbscan.least_forest(a, b, w).tolist() == [3, 0, 1]
    assert hdbscan.least_forest(*(np.zeros(0, int),) * 2, np.zeros(0)).tolist() == []


def test_one_table_nulls_and_none(spark, table):
    whole = table.filter("g = 'a'").select("id", "vector")
    odd = spark.createDataFrame([(1, None), (2, [1.0, None, 0.0, 0.0, 0.0]), (3, [float("nan")] * 5)], "id long, vector array<double>")
    got = {r.id: r.label for r in hdbscan.clustered(whole.unionByName(odd), [], 5, 3, True, 30).collect()}
    plain = {r.id: r.label for r in hdbscan.clustered(whole, [], 5, 3, True).collect()}
    assert got == plain | {1: -1, 2: -1, 3: -1}
    assert hdbscan.clustered(table.limit(0), ["g"], 5, 3).count() == 0


def test_a_task_holds_two_blocks(table):
    rows = table.withColumn("x", F.col("vector")).select("g", "id", "x")
    sizes = rows.groupBy("g").agg(F.ceil(F.count("*") / 20).cast("int").alias("_k"))
    dealt = rows.join(sizes, "g").withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_k")).cast("int"))
    pairs = hdbscan._by_pairs(dealt, True).groupBy("g", "_i", "_j").count().collect()
    assert max(r["count"] for r in pairs) < 80 and {(r._i, r._j) for r in pairs if r.g == "b"} == {(i, j) for j in range(5) for i in range(j + 1)}


def test_large_blocks_take_the_nearest_by_products():
    """Neighbours of many vectors at once, copies and far ends included, are those of all distances."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(1500, 6)), np.repeat(rng.normal(size=(1, 6)), 40, axis=0), 1e4 + rng.normal(size=(20, 6)), np.zeros((3, 6))])
    y = np.concatenate([x[::3], rng.normal(size=(1200, 6))])
    d, at = hdbscan.nearest_of(x, x, 5, True)
    assert np.allclose(d, hdbscan.nearest_distances(x, x, 6, True)[:, 1:], atol=1e-3) and (at != np.arange(len(x))[:, None]).all()
    d, at = hdbscan.nearest_of(x, y, 5, False)
    far = np.sqrt(((x[:, None] - y[at]) ** 2).sum(2))
    assert np.allclose(d, far, atol=1e-5) and np.allclose(d, np.sort(np.sqrt(((x[:, None] - y) ** 2).sum(2)), axis=1)[:, :5], atol=1e-5)


def test_only_parts_that_may_be_nearer_are_asked():
    """An edge is sure if no edge that isn't listed can be less; what is left names the least known edge of its part."""
    ids, floor = np.array([1, 2, 3, 4]), np.array([2.0, 9.0, 0.5, 0.5])
    kept, part, least = hdbscan.joined(ids, floor, np.array([1, 3, 2]), np.array([2, 4, 3]), np.array([1.0, 1.0, 3.0]), np.array([False, True, False]))
    assert kept.tolist() == [0, 1] and part[0] == part[1] != part[2] == part[3] and least.tolist() == [2] * 4
    kept, part, _ = hdbscan.joined(ids, floor, np.array([1, 3, 2]), np.array([2, 4, 3]), np.array([1.0, 1.0, 3.0]), np.array([False, True, True]))
    assert kept.tolist() == [0, 1, 2] and len(set(part)) == 1


def test_clusters_far_apart_and_copies(spark, monkeypatch):
    """No list of neighbours leaves a cluster here, one vector stands there 60 times, and the copies' blocks meet others."""
    rng = np.random.default_rng(7)
    x = np.concatenate([50 * k + rng.normal(size=(70, 4)) for k in range(4)] + [np.repeat(rng.normal(size=(1, 4)), 60, axis=0)])
    x = x[rng.permutation(len(x))]
    calls = []
    monkeypatch.setattr(hdbscan, "tree_of", lambda *a: calls.append(a))  # only labels_of works out all distances
    got = {r.id: r.label for r in hdbscan.clustered(spark.createDataFrame([(i, [float(v) for v in z]) for i, z in enumerate(x)], "id long, vector array<double>"), [], 5, 2, True, 64).collect()}
    monkeypatch.undo()
    assert got == dict(enumerate(hdbscan.labels_of(x, 5, 2, True).tolist())) and not calls and len(set(got.values()) - {-1}) >= 4
