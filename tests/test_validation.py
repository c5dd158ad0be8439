"""Validation that runs rules, on a table that is worked out by hand."""

from bugloom.operators import patterns
from bugloom.plans import batch

HIT, MISS = "val x = Await.result(f, d)", "val x = f.map(g)"
RULE = "no-await-result-in-production"


def test_counts_by_hand(spark):
    own = [(i, 1, "scala", i, f"S{i}.scala", HIT if i < 6 else MISS) for i in range(8)]
    own += [(8, 1, "scala", 8, "test/S.scala", HIT), (9, 1, "scala", 9, "S.scala", None), (10, 1, "go", 10, "S.go", HIT)]
    off = [(i, 2 if i % 2 else None, "scala", i, f"S{i}.scala", HIT if i % 10 == 0 else MISS) for i in range(100, 140)]
    entries = spark.createDataFrame(own + off, "id int, cluster_id int, language string, ord int, path string, text string")
    rules = spark.createDataFrame([("a", RULE, 1, "scala", "scalafix"), ("b", RULE, 2, "scala", "opengrep"), ("c", "unknown", 1, "scala", "scalafix"), ("d", RULE, 77, "scala", "opengrep")], "rule_id string, pattern string, cluster_id int, language string, target string")
    clean = spark.createDataFrame([(500, "scala", "C.scala", HIT), (501, "scala", "C.scala", MISS)], "id int, language string, path string, text string")
    got = {r.rule_id: r for r in batch.rule_validation(entries, rules, clean).collect()}
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.n_tests, a.matched, a.n, a.fp, a.clean) == (10, 6, 20, 2, 1)
    assert (a.precision, a.recall_in_cluster, a.ship) == (1 - 2 / 20, 0.6, True)
    assert (b.n_tests, b.matched, b.n, b.fp) == (20, 0, 20, 8)  # ids 0 to 9, then 100, 102 to 118: six hits, then 100 and 110
    assert (c.matched, c.fp, c.precision, c.ship) == (0, 0, 1.0, False)
    assert (d.n_tests, d.recall_in_cluster, d.ship) == (0, 0.0, False)
    assert {r.clean for r in batch.rule_validation(entries, rules).collect()} == {0}


def test_each_text_meets_its_own_rule_only(spark):
    files = spark.createDataFrame([(RULE, "a.scala", HIT + "\n" + HIT, 7), ("missing-meta-site-filter-mongo", "a.scala", HIT, 8), (RULE, "a.py", HIT, 9), (None, "a.scala", HIT, 10)], "pattern string, path string, text string, k int")
    assert sorted((r.k, r.line) for r in patterns.keyed_findings(files).collect()) == [(7, 1), (7, 2)]


def test_texts_do_not_meet_by_language(spark):
    """Rules go to the texts, as all texts of a language would meet in one task."""
    from bugloom.plans import batch

    texts = spark.range(40).selectExpr("id", "CAST(id % 4 AS int) AS cluster_id", "'scala' AS language", "id AS ord", "concat('dao/B', id, '.scala') AS path", "'val x = Await.result(call(a, b), 5)' AS text")
    rules = spark.range(4).selectExpr("concat('r', id) AS rule_id", "'no-await-result-in-production' AS pattern", "CAST(id AS int) AS cluster_id", "'scala' AS language", "'opengrep' AS target")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = batch.rule_validation(texts, rules, texts.select("id", "language", "path", "text"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.rule_id: (r.n_tests, r.n, r.matched, r.clean) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {f"r{k}": (10, 20, 10, 40) for k in range(4)}
    assert "SortMergeJoin [cluster_id" not in plan and "SortMergeJoin [language" not in plan


def test_rows_of_texts_are_kept_as_they_are(spark):
    """Texts become objects a few at a time; what stands beside them stays in Arrow: large numbers beside nulls, lists, moments."""
    columns = "CASE WHEN id % 2 = 0 THEN 9007199254740993 + id END AS n", "CASE WHEN id % 3 > 0 THEN array(id, NULL) END AS xs", "timestamp_micros(id) AS t", "CASE WHEN id % 5 > 0 THEN id % 2 = 0 END AS b"
    files = spark.range(0, 900, 1, 1).selectExpr("id", *columns, f"'{RULE}' AS pattern", "'a.scala' AS path", f"IF(id % 9 = 0, '{MISS}', '{HIT}\\n\\n{HIT}') AS text")
    found = patterns.keyed_findings(files)
    assert found.columns == ["id", "n", "xs", "t", "b", "pattern", "line"] and "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    want = files.filter("id % 9 > 0").selectExpr("id", "n", "xs", "t", "b", "pattern", "explode(array(1, 3)) AS line")
    assert found.count() == 1600 and found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    assert patterns.keyed_findings(files.filter("id % 9 = 0")).isEmpty()
