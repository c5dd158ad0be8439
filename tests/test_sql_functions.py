"""Table functions in SQL, and embeddings that need no service."""

import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from bugloom.functions import registry
from bugloom.operators import vectorise
from bugloom.plans import batch


def test_place_sums_over_a_table_argument(spark):
    registry.register(spark)
    rows = [("a", 0, [1.0, 2.0]), ("a", 1, [3.0, None, 5.0]), ("a", 1, None), ("b", 0, []), (None, 0, [1.0])]
    spark.createDataFrame(rows, "k string, part int, v array<double>").createOrReplaceTempView("vs")
    got = spark.sql("SELECT k, place, sum(total) / sum(n) AS mean, sum(n) AS n FROM place_sums(TABLE(vs) PARTITION BY (k, part), 'v') GROUP BY k, place").collect()
    assert {(r.k, r.place): (r["mean"], r.n) for r in got} == {("a", 1): (2.0, 2), ("a", 2): (2.0, 1), ("a", 3): (5.0, 1), (None, 1): (1.0, 1)}
    with pytest.raises(Exception, match="vector column"):
        spark.sql("SELECT * FROM place_sums(TABLE(vs), 'nothing')").collect()


def test_lateral_functions(spark):
    registry.register(spark)
    spark.createDataFrame([(1, "diff --git a/x b/x\n@@ -1 +2,3 @@\n-a"), (2, None), (3, "")], "id int, d string").createOrReplaceTempView("ds")
    assert [tuple(r) for r in spark.sql("SELECT id, f.* FROM ds, LATERAL diff_ranges(d) f").collect()] == [(1, "x", 2, 4)]
    assert [tuple(r) for r in spark.sql("SELECT id, f.path, f.removed FROM ds, LATERAL parse_diff(d, false) f").collect()] == [(1, "x", "a")]


def test_hashed_embeddings(spark):
    texts = ["def f(x): return x + x", "", None, "zz", "def g(y): return y + y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: list(r.vector) for r in vectorise.hashed(docs, vectorise.code_tokens(F.col("text")), 16).collect()}
    assert set(got) == {0, 3, 4}
    want = [0.0] * 16
    for term, n in collections.Counter("def return +".split()).items():
        h = hashlib.md5(term.encode()).hexdigest()
        want[int(h[:8], 16) % 16] += (1 if int(h[8:16], 16) % 2 == 0 else -1) * (1 + math.log(n))
    assert [round(x, 9) for x in got[0]] == [round(x / math.sqrt(sum(y * y for y in want)), 9) for x in want]
    assert math.isclose(sum(x * x for x in got[3]), 1)


def test_the_batch_needs_no_embedding_function(spark):
    code = [f"val x{i % 3} = items.map(_.size).sum - {i}" if i % 2 else f"try {{ f({i}) }} catch {{ case e: Throwable => log }}" for i in range(12)]
    blocks = F.array(F.struct(F.lit("A.scala").alias("file_path"), F.lit("scala").alias("language"), F.col("code").alias("content")))
    inducing = spark.createDataFrame([(f"B{i}", "r", c) for i, c in enumerate(code)], "bug_key string, repo string, code string").select("bug_key", "repo", blocks.alias("blocks"), F.lit(0.7).alias("szz_confidence"))
    bugs = spark.createDataFrame([(f"B{i}", "s", ["l"], i) for i in range(12)], "key string, summary string, labels array<string>, ord int")
    fixes = spark.createDataFrame([(f"B{i}", "r", "d", 1, i) for i in range(12)], "bug_key string, repo string, diff string, lines_removed int, ord int")
    out = batch.run(inducing, bugs, fixes, settings=batch.Settings(min_cluster_size=2, min_commits=1))
    assert out["corpus"].count() == 12 and out["clusters"].count() >= 2
