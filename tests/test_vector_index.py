"""The index against brute force: recall, exact answers, pruning, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bugloom.operators import vector_index, vectorise

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


@pytest.fixture(scope="module")
def index(spark, vectors, tmp_path_factory):
    path = "file://" + str(tmp_path_factory.mktemp("index"))
    vector_index.built(vectors, path, 16)
    return path


def test_every_vector_is_in_one_list(spark, vectors, index):
    rows = vector_index.lists_at(spark, index)
    assert sorted(r.id for r in rows.collect()) == sorted(r.id for r in vectors.collect())
    sizes = {r.list: r["count"] for r in rows.groupBy("list").count().collect()}
    assert sizes == {r.list: r.size for r in spark.read.parquet(f"{index}/centres").collect()}


def test_recall_and_exactness(spark, vectors, index):
    asked = vectors.filter("id % 50 = 0")
    truth = vectorise.knn(asked, vectors, 5)
    some = [vector_index.recall(vector_index.search(spark, index, asked, 5, n), truth) for n in (1, 10, 16)]
    assert some[0] < 1 and some[1] >= 0.9 and some[2] == 1.0
    exact = vector_index.search(spark, index, asked, 5, 1, exact=True)
    key = lambda df: sorted((r.query, r["rank"], r.id, round(r.cos, 9)) for r in df.collect())
    assert key(exact) == key(truth)


def test_only_probed_lists_are_read(spark, vectors, index):
    found = vector_index.search(spark, index, vectors.filter("id = 50"), 3, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan and found.count() == 3
    lists = {r.list for r in vector_index.lists_at(spark, index).join(found.select("id"), "id").collect()}
    assert 1 <= len(lists) <= 2


def test_a_tight_index_needs_few_lists(spark, tmp_path):
    """Where clusters are tight, the bound shows that other lists can't hold better."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8))
    rows = [(i, [float(v) for v in centres[i % 12] + 0.01 * rng.normal(size=8)]) for i in range(600)]
    df, path = spark.createDataFrame(rows, "id long, vector array<double>"), f"file://{tmp_path}"
    vector_index.built(df, path, 12)
    q = df.filter("id < 12")
    assert vector_index.recall(vector_index.search(spark, path, q, 5, 2), vectorise.knn(q, df, 5)) == 1.0
    table = spark.read.parquet(f"{path}/centres").toArrow()
    bounds = vector_index._asked(q, table, 1).filter("NOT near AND bound < 0.9").count()
    assert bounds > 60


def test_copies_and_odd_rows(spark, tmp_path, monkeypatch):
    """A third of all rows alike is dealt out; vectors without a direction, of another length or null aren't in the index."""
    for name, v in (("PART", 50), ("ASKED", 5)):
        monkeypatch.setattr(vector_index, name, v)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else [float(v) for v in rng.normal(size=4)]) for i in range(300)]
    odd = [(1000, None), (1001, [0.0] * 4), (1002, [1.0, None, 1.0, 1.0]), (1003, [float("nan")] * 4), (1004, [1.0]), (1005, [])]
    df, path = spark.createDataFrame(rows + odd, "id long, vector array<double>").repartition(3), f"file://{tmp_path}"
    vector_index.built(df, path, 6)
    assert vector_index.lists_at(spark, path).count() == 300
    whole = spark.createDataFrame(rows, "id long, vector array<double>")
    got = vector_index.search(spark, path, df.filter("id % 25 = 0 OR id >= 1000"), 4, 1, exact=True)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cos = np.round(x @ x.T, 12)
    np.fill_diagonal(cos, -2)
    want = {(q, n + 1, int(i)) for q in range(0, 300, 25) for n, i in enumerate(np.lexsort((np.arange(300), -cos[q]))[:4])}
    assert {(r.query, r["rank"], r.id) for r in got.collect()} == want and whole.count() == 300


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "id long, vector array<double>")
    vector_index.built(none, f"file://{tmp_path}", 4)
    assert vector_index.search(spark, f"file://{tmp_path}", none, 3, 2, exact=True).count() == 0


def test_nearest_by_blocks_is_that_of_pairs(spark, monkeypatch):
    """No pair of vectors is a row of its own; odd vectors and copies rank as they do by pairs."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from bugloom.functions.vectors import cosine

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(40)] + [(400 + i, [2 * x for x in rows[100][1]]) for i in range(5)]
    rows += [(500, None), (501, [0.0] * 6), (502, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (503, [1.0, 2.0]), (504, [float("nan")] * 6), (505, [1e200] * 6), (550, [3.0, 1.0]), (600, None)]
    df = spark.createDataFrame(rows, "id long, vector array<double>").repartition(3)
    q = df.filter("id % 50 = 0").select(F.col("id").alias("query"), F.col("vector").alias("q"))
    ranked = df.crossJoin(q).filter("id <> query").withColumn("cos", cosine(F.col("vector"), F.col("q")))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cos"), "id"))).filter("rank <= 5")
    key = lambda d: sorted((r.query, r["rank"], r.id, str(r.cos)) for r in d.collect())
    monkeypatch.setattr(vectorise, "BLOCK", 64)
    got = vectorise.knn(df.filter("id % 50 = 0"), df, 5)
    assert key(got) == key(ranked)
    assert "aggregate(zip_with" in ranked._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(zip_with" not in got._jdf.queryExecution().executedPlan().toString()
