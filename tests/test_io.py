"""Readers, writers, streams and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from bugloom import schemas
from bugloom.plans import batch, cli
from bugloom.sources import readers, sinks
from bugloom.streaming import incremental


def test_json_lines(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"bug_key": "A", "extra": 1}\n\nnot json\n{"bug_key": "B", "jira_labels": ["x"]}\n')
    assert [r.bug_key for r in readers.json_lines(spark, str(tmp_path / "c.jsonl"), schemas.CORPUS).collect()] == ["A", "B"]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        readers.json_lines(spark, str(tmp_path / "c.jsonl"), schemas.CORPUS, strict=True).collect()


def test_git_log(spark, tmp_path):
    (tmp_path / "log").write_text("\x1e\n".join("\0".join(r) for r in (["s1", "me", "2024", "fix: a", "body\nmore"], ["short"], ["s2", "you", "2025", "b", ""])))
    assert [(r.sha, r.body) for r in readers.git_log(spark, str(tmp_path / "log")).collect()] == [("s1", "body\nmore"), ("s2", "")]


def test_config():
    text = '[mine]\nticket_pattern = "AB-[0-9]+"\nservices = ["x:dev", "y"]\ntoken = "env:TOKEN"'
    got = readers.config(text, {"TOKEN": "t"})["mine"]
    assert got["ticket_pattern"] == r"(?i)\b(AB-[0-9]+)\b" and got["repos"] == [{"name": "x", "branch": "dev"}, {"name": "y", "branch": "main"}] and got["token"] == "t"


def test_rule_discovery(spark):
    src = spark.createDataFrame([("b", 'class Foo extends SemanticRule("Foo") { Diagnostic("id", "Bad Thing") }'), ("a", 'class Foo extends SyntacticRule("Foo")'), ("c", "object None")], "path string, text string")
    why = spark.createDataFrame([("r.md", "Foo leaks data loss. PR 12345 - a title\nhttps://h/o/r/pull/12345 (another)\nregex_hint: `x+`")], "path string, text string")
    got = readers.rule_specs(src, why, "https://h/o", "r").collect()
    assert [(r.name, r.source_path, r.severity, r.regex_hint, [tuple(c) for c in r.citations]) for r in got] == [("Foo", "a", "high", "x+", [("https://h/o/r/pull/12345", "another")])]
    yaml = spark.createDataFrame([("opengrep/a.yaml", "rules:\n- id: r1\n  severity: ERROR\n  languages: [go]\n  message: >\n    a\n    b\n"), ("x/b.yml", "other: 1"), ("deferred/c.yaml", "rules: []"), ("x/d.yaml", "rules: [")], "path string, text string")
    files = readers.yaml_rule_files(yaml)
    assert {r.path for r in files.collect()} == {"opengrep/a.yaml", "x/d.yaml"}
    assert [(r.id, r.severity, r.message, r.category) for r in readers.yaml_rules(files).collect()] == [("r1", "high", "a b", "uncategorized")]


def test_engine_and_compiler_findings(spark):
    report = json.dumps({"results": [{"path": "a/B.scala", "check_id": "p.q.rule", "start": {"line": 3}, "extra": {"message": " m ", "severity": "ERROR", "lines": " code "}}, {"path": "a/test/B.scala", "check_id": "r"}]})
    got = readers.engine_findings(spark.createDataFrame([(report,), ("broken",)], "report string")).collect()
    assert [tuple(r) for r in got] == [("rule", "high", "a/B.scala", 3, "code", "m")]
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["a.scala:1:2: error: [fix.R] bad", "val x", "  ^", "b.scala:2: info: [S] hm", "y"])], "run int, n int, line string")
    assert {(r.rule, r.severity, r.line, r.snippet) for r in readers.compiler_findings(lines).collect()} == {("R", "high", 1, "val x   ^"), ("S", "low", 2, "y")}


def test_iterations_and_candidates(spark):
    files = spark.createDataFrame([("s/scan_iter2_web.json",), ("s/scan_iter10b_api.json",), ("s/scan_iter10_x.json",), ("s/other.json",)], "path string")
    assert {(r.iter, r.suffix, r.repo) for r in readers.latest_scans(files).collect()} == {(10, "b", "api"), (10, "", "x")}
    c = spark.createDataFrame([("cluster_1/a.scala", "class X extends R"), ("cluster_1/why.md", "because"), ("cluster_2/SKIPPED", ""), ("cluster_3/n.txt", "")], "path string, text string")
    assert {r.cluster: (r.status, r.class_name, r.rationale) for r in readers.candidates(c).collect()} == {"cluster_1": ("rule", "X", "because"), "cluster_2": ("skipped", "", ""), "cluster_3": ("unknown", "", "")}


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([(1, f"k{i}", f"a/b/c/f{i % 2}.scala", f"s{i}", "code", i) for i in range(4)] + [(2, "k", "x", "s", "c", 9), (-1, "k", "x", "s", "c", 10)], "cluster_id int, bug_key string, file_path string, bug_summary string, buggy_code string, ord int")
    b = sinks.cluster_bundles(e).collect()
    assert [(r.cluster_id, r.size, r.n_commits, r.top_files[0]["name"], r.bug_summaries) for r in b] == [(1, 4, 4, "f0.scala", ["s0", "s1", "s2", "s3"])]
    f = spark.createDataFrame([("R", "high", f"f{i:03}", i, "s") for i in range(60)], "rule string, severity string, file string, line int, snippet string")
    text = sinks.scan_markdown(f).first().markdown
    assert text.count("- `") == 50 and text.endswith("and 10 more")
    assert sinks.scan_report(f, "r", "now").first().summary.by_rule == {"R": 60}
    fixes = spark.createDataFrame([("A", 2, "x"), ("A", 1, "y"), ("Z", 3, "z")], "bug_key string, pr_number int, repo string")
    bugs = spark.createDataFrame([("A", None), ("B", None)], "key string, resolved_at timestamp")
    out = sinks.nested_bugs(bugs, fixes)
    sinks.write_json(out, str(tmp_path / "bugs"))
    assert [r.pr_number for r in out.first().fixing_commits] == [1, 2] and out.count() == 1
    rules = spark.createDataFrame([("no-x", 1, ["B1"], "scalafix", "src", ["i"], ["o"], "why")], schemas.CANDIDATE_RULES)
    assert {r.path for r in sinks.candidate_files(rules).collect()} == {"no-x.scala", "no-x.meta.json"}
    v = spark.createDataFrame([("no-x", 0.9, 1.0, 0, None, True)], schemas.VALIDATION)
    assert sinks.ship_plan(rules, v, "r").first().path == "rules/src/main/scala/fix/NoX.scala"


def test_batches_merge_into_partitions(spark, tmp_path):
    path, schema = f"file://{tmp_path}/t", "k string, v int, n int"
    merge = lambda rows, batch: incremental.merged_into(path, spark.createDataFrame(rows, schema), batch, schema, ["k"], lambda c, old, new: old + new if c == "n" else new, 8)
    read = lambda: {tuple(r) for r in incremental.merged_rows(spark, path, schema).select("k", "v", "n").collect()}
    assert read() == set()
    merge([("a", 1, 1), ("b", 2, 1), (None, 3, 1)], 0)
    merge([("a", 5, 2), ("c", 6, 1), (None, 7, 4)], 1)
    want = {("a", 5, 3), ("b", 2, 1), ("c", 6, 1), (None, 7, 5)}
    assert read() == want
    merge([("a", 5, 2), ("c", 6, 1), (None, 7, 4)], 1)  # the batch comes again
    merge([], 2)
    assert read() == want
    files = lambda: {f.stat().st_ino for f in tmp_path.glob("t/bucket=*/*.parquet")}
    before = files()
    merge([("b", 9, 1)], 3)
    assert read() == want - {("b", 2, 1)} | {("b", 9, 2)} and len(before - files()) == 1  # one partition is written anew
    merge([(f"k{i}", i, 1) for i in range(40)], 4)
    assert len(read()) == 44


def test_bucketed_tables_join_where_they_lie(spark, tmp_path):
    a = sinks.bucketed(spark.range(1000).selectExpr("id", "id % 7 AS x"), f"file://{tmp_path}/a", "id", 4)
    b = sinks.bucketed(spark.range(500, 1500).selectExpr("id", "id % 5 AS y"), f"file://{tmp_path}/b", "id", 4)
    assert len(list((tmp_path / "a").glob("part-*"))) == 4
    rows = readers.rows_of_table(spark, a, ["id", "x"], "x = 3").join(readers.rows_of_table(spark, b, ["id", "y"]).hint("merge"), "id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(x), EqualTo(x,3)" in plan and rows.count() == sum(i % 7 == 3 for i in range(500, 1000))
    spark.sql(f"DROP TABLE {a}")
    assert spark.read.parquet(f"file://{tmp_path}/a").count() == 1000


def test_bundles_of_the_preferred_folder(spark, tmp_path):
    assert readers.preferred_bundles(spark, str(tmp_path)).count() == 0
    for folder, lang, k in (("clusters", "go", 1), ("clusters", "scala", 2)):
        (tmp_path / folder / lang / f"cluster_{k}").mkdir(parents=True)
        (tmp_path / folder / lang / f"cluster_{k}" / "bundle.json").write_text('{\n "cluster_id": %d, "size": 3,\n "bug_summaries": ["a"]}' % k)
        (tmp_path / folder / lang / f"cluster_{k}" / "other.json").write_text("{}")
    read = lambda: {(r.cluster_id, r.language, r.folder) for r in readers.preferred_bundles(spark, str(tmp_path)).collect()}
    assert read() == {(1, "go", "clusters"), (2, "scala", "clusters")}
    (tmp_path / "clusters_v2" / "go" / "cluster_9").mkdir(parents=True)
    (tmp_path / "clusters_v2" / "go" / "cluster_9" / "bundle.json").write_text('{"cluster_id": 9}')
    assert read() == {(9, "go", "clusters_v2")}


def test_stream_state_over_restarts(spark, tmp_path):
    at, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "user long"
    for batch_ in ([1, 1, 2], [1, 2, 3], [1, 2]):
        spark.createDataFrame([(x,) for x in batch_], schema).coalesce(1).write.mode("append").parquet(at)
        stream = incremental.threshold_crossings(spark.readStream.schema(schema).parquet(at), "user", 3)
        incremental.run_once(stream, state, path=out)
    assert sorted((r.user, r.n) for r in spark.read.parquet(out).collect()) == [(1, 3), (2, 3)]


def test_windows_and_late_rows(spark, tmp_path):
    rows = [("2024-01-01 01:00:00", "a"), ("2024-01-01 02:00:00", "a"), ("2024-01-05 00:00:00", "b")]
    spark.createDataFrame(rows, "ts string, k string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.windowed_counts(spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "in")), "ts", "k")
    incremental.run_once(stream, str(tmp_path / "s"), path=str(tmp_path / "o"))
    assert [(r.k, r["count"]) for r in spark.read.schema(stream.schema).parquet(str(tmp_path / "o")).collect()] == [("a", 2)]


def test_batch_plan(spark):
    block = lambda p, c: [{"file_path": p, "language": "scala", "content": c}]
    inducing = spark.createDataFrame([(f"B{i}", "r", block(f"f{i}", f"code {i}"), 0.7) for i in range(8)], "bug_key string, repo string, blocks array<struct<file_path: string, language: string, content: string>>, szz_confidence double")
    bugs = spark.createDataFrame([(f"B{i}", f"crash {i}" if i else "chore: x", ["l"], i) for i in range(9)], "key string, summary string, labels array<string>, ord int")
    fixes = spark.createDataFrame([(f"B{i}", "r", "d", 1, 0) for i in range(8)], "bug_key string, repo string, diff string, lines_removed int, ord int")
    embed = lambda d: d.withColumn("vector", F.array(F.when(F.pmod("id", F.lit(2)) == 0, 1.0).otherwise(0.0), F.lit(1.0)))
    out = batch.run(inducing, bugs, fixes, embed, batch.Settings(repo="r", min_cluster_size=2, min_commits=1))
    assert out["corpus"].count() == 7 and out["clusters"].columns == ["cluster_id", "centroid", "size"] and out["bundles"].count() >= 0


def test_cli_scan(spark, tmp_path):
    src = tmp_path / "src" / "a"
    src.mkdir(parents=True)
    (src / "A.scala").write_text("val openSpots = capacity - participants\n")
    (src / "ATest.scala").write_text("val openSpots = capacity - participants\n")
    assert cli.main(["scan", str(tmp_path / "src"), str(tmp_path / "out")]) == 0
    assert [(r.rule, r.file, r.line) for r in spark.read.json(str(tmp_path / "out/findings")).collect()] == [("UnclampedOpenSpots", "a/A.scala", 1)]
    assert spark.read.json(str(tmp_path / "out/summary")).count() == 7
    (tmp_path / "hits.jsonl").write_text('{"rule": "x", "positive": true}\n{"rule": "y", "positive": false}\n')
    assert cli.main(["gate", str(tmp_path / "hits.jsonl")]) == 1


FIXTURE_DIFF = """diff --git a/src/A.scala b/src/A.scala
index 1..2 100644
--- a/src/A.scala
+++ b/src/A.scala
@@ -3,2 +3,3 @@ class A
 same
-old line
+new line
+another
diff --git a/src/Gone.scala b/src/Gone.scala
deleted file mode 100644
--- a/src/Gone.scala
+++ /dev/null
@@ -1 +0,0 @@
-val gone = 1
"""
FIXTURE_SOURCE = 'class OpenSpots {\n  val openSpots = capacity - participants\n  def f = logger.info(s"got $form.id")\n}\n'


def test_sql_table_functions(spark):
    from bugloom.functions import registry

    registry.register(spark)
    spark.createDataFrame([("a.scala", FIXTURE_SOURCE, FIXTURE_DIFF)], "path string, text string, diff string").createOrReplaceTempView("inputs")
    assert {(r.rule, r.line) for r in spark.sql("SELECT f.* FROM inputs, LATERAL scan_text(path, text, NULL) f").collect()} == {("UnclampedOpenSpots", 2), ("BrokenInterpolationFieldAccess", 3)}
    assert [(r.path, r.removed) for r in spark.sql("SELECT f.* FROM inputs, LATERAL parse_diff(diff, true) f ORDER BY ord").collect()] == [("src/A.scala", "old line"), ("src/Gone.scala", "val gone = 1")]
    assert [tuple(r) for r in spark.sql("SELECT f.* FROM inputs, LATERAL diff_ranges(diff) f").collect()] == [("src/A.scala", 3, 5)]


def test_cli_cluster(spark, tmp_path):
    rows = []
    for era, year in enumerate((2016, 2020)):
        for k in range(24):
            centre = [1.0, 0.0] if k % 2 else [0.0, 1.0]
            rows.append({"bug_key": f"B{era}-{k}", "file_path": f"a/f{k}.scala", "language": "scala", "buggy_code": f"x{era}{k}", "bug_summary": "crash", "embedding": [c + 0.001 * k for c in centre], "committed_at": f"{year}-01-01"})
    rows.append({**rows[0], "bug_key": "N", "bug_summary": "Merge branch x"})
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert cli.main(["cluster", str(tmp_path / "c.jsonl"), str(tmp_path / "out")]) == 0
    found = spark.read.json(str(tmp_path / "out/bundles")).collect()
    assert sum(r.size for r in found) >= 40 and {r.cluster_id // 1000 for r in found} == {0, 1}
    s = spark.read.json(str(tmp_path / "out/summary")).first()
    assert (s.language, s.n_raw, s.n_filtered, s.n_clusters, s.n_dropped) == ("scala", 49, 48, len(found), 0)


def test_pattern_rules(spark):
    from bugloom.operators import patterns

    files = spark.createDataFrame([("a.go", "x, _ = f()\n"), ("a.py", "x, _ = f()\n"), ("b.go", None), (None, "x, _ = f()"), ("src/__tests__/a.ts", "prices.sort()"), ("src/a.ts", "prices.sort()\nnew Date()")], "path string, text string")
    assert sorted((r.rule, r.file, r.line) for r in patterns.pattern_findings(files).collect()) == [("go-ignored-error", "a.go", 1), ("ts-array-sort-numbers-without-comparator", "src/__tests__/a.ts", 1), ("ts-array-sort-numbers-without-comparator", "src/a.ts", 1)]
    named = patterns.pattern_findings(files, names=("calendar-now-without-explicit-timezone",)).collect()
    assert [(r.file, r.line) for r in named] == [("src/a.ts", 2)]
