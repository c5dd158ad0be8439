"""Operators on small fixtures that the star-schema tables don't reach."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bugloom.functions import text as T
from bugloom.functions import vectors as V
from bugloom.operators import corpus, diffs, hdbscan, quality, relational, report, rules, scanners, vectorise

SHOW = "\n".join(
    ["diff --git a/x/A.scala b/x/A.scala", "index 1..2", "--- a/x/A.scala", "+++ b/x/A.scala", "@@ -1,2 +1,2 @@", " keep", "-old", "--- gone dashes", "+new", "diff --git a/b/Old.ts b/b/New.ts", "similarity index 100%", "rename from b/Old.ts", "diff --git a/D.scala b/D.scala", "--- a/D.scala", "+++ /dev/null", "@@ -1 +0,0 @@", "-all", "\\ No newline at end of file", "diff --git a/p.png b/p.png", "Binary files differ"]
)


def test_diffs_of_shows_and_pulls():
    assert [(p, r) for p, _, r in diffs.files_of_show(SHOW)] == [("x/A.scala", "old"), ("D.scala", "all")]
    pulled = {p: (b, r) for p, b, r in diffs.files_of_pull(SHOW)}
    assert set(pulled) == {"x/A.scala", "D.scala"}
    assert pulled["x/A.scala"] == ("@@ -1,2 +1,2 @@\n keep\n-old\n+new", "old")  # a removed line that looks like a header is none
    assert diffs.ranges_of("diff --git a/f b/f\n+++ b/f\n@@ -1 +3 @@\n@@ -5,2 +7,4 @@ x\n@@ -9,2 +9,0 @@") == [("f", 3, 3), ("f", 7, 10)]
    assert diffs.ranges_of("diff --git a/f b/f\n+++ b/f\n@@ -1 +1,2 @@\n+++ other.txt\n x\n@@ -9 +10 @@\n+y") == [("f", 1, 2), ("f", 10, 10)]
    assert diffs.files_of_show("") == [] == diffs.files_of_pull(None)


def test_corpora(spark):
    big = "x" * 60_000
    rows = [("r", "s" * 40, "Fix: crash (#12) PROJ-7", "body proj-9", "2024-01-31T23:30:00-02:00", SHOW), ("r", "t" * 40, "Add thing", "", "2024", SHOW), ("r", "u" * 40, "fix(ui): x", None, None, f"diff --git a/a/B.ts b/a/B.ts\n@@ -1 +1 @@\n-{big}é\n")]
    commits = spark.createDataFrame(rows, "repo string, sha string, subject string, message string, committed_at string, diff string")
    got = {(r.bug_key, r.file_path): r for r in diffs.commit_corpus(commits).collect()}
    assert set(got) == {("commit-" + "s" * 12, "x/A.scala"), ("commit-" + "s" * 12, "D.scala"), ("commit-" + "u" * 12, "a/B.ts")}
    one = got["commit-" + "s" * 12, "x/A.scala"]
    assert (one.pr_number, one.jira_labels, one.language) == (12, ["PROJ-7", "PROJ-9"], "scala")
    assert len(got["commit-" + "u" * 12, "a/B.ts"].fix_diff.encode()) <= 51_200
    pulls = spark.createDataFrame([("r", 5, "hotfix[x] y", "m", "u", SHOW), ("r", 6, "fix: z", "m", "u", rows[2][5])], "repo string, number int, title string, message string, url string, diff string")
    assert {(r.bug_key, r.file_path) for r in diffs.pull_corpus(pulls).collect()} == {("PR-5", "x/A.scala"), ("PR-5", "D.scala")}


def test_cut_bytes_keep_whole_characters(spark):
    got = spark.createDataFrame([("aé",)], "x string").select(T.byte_capped(F.col("x"), 2).alias("x")).first().x
    assert got == "a�"


def found(source, path, text):
    return list(scanners.SCANNERS[source][1](path, text))


CALENDAR = "CalendarNowWithoutExplicitTimezone"


@pytest.mark.parametrize(
    ("rule", "path", "text", "n"),
    [
        (CALENDAR, "Foo.scala", "class Foo { val a = DateTime.now() }", 0),
        (CALENDAR, "backend/calendar-3/Foo.scala", "class Foo { f(DateTime.now()) }", 1),
        (CALENDAR, "backend/calendar-3/Clock.scala", "class SystemClock { f(DateTime.now()) }", 0),
        (CALENDAR, "backend/calendar-3/Foo.scala", "x.getOrElse(DateTime.now()).withZone(z)", 0),
        (CALENDAR, "backend/calendar-3/Foo.scala", "x.getOrElse(DateTime.now())", 1),
        (CALENDAR, "calendar/A.scala", "Row(updatedAt = Some(DateTime.now()))", 0),
        (CALENDAR, "calendar/A.scala", "DateTime.now().getMillis", 0),
        ("StaffQueryMissingAppDefId", "backend/foo/SomeService.scala", "staffMembersAdapter.queryStaffMembers(id)", 0),
        ("StaffQueryMissingAppDefId", "backend/foo/SomeAdapter.scala", "staffMembersService.queryStaffMembers(id, f(x))", 1),
        ("StaffQueryMissingAppDefId", "a.scala", "staffMembersService.queryStaffMembers(appDefId = a)", 0),
        ("StaffQueryMissingAppDefId", "a.scala", "staffMembersService.queryStaffMembers(request)", 0),
        ("UnclampedOpenSpots", "a.scala", "val openSpots = capacity - participants", 1),
        ("UnclampedOpenSpots", "a.scala", "lazy val openSpots = capacity - participants", 2),
        ("UnclampedOpenSpots", "a.scala", "val openSpots = Math.max(capacity - participants, 0)", 0),
        ("UnclampedOpenSpots", "a.scala", "x.withOpenSpots(a - b)", 1),
        ("MissingDollarInInterpolation", "a.scala", 'val userId = 1\nlog(s"userId = $userId")\nlog(s"x = userId")', 1),
        ("MissingDollarInInterpolation", "a.scala", 'val other = 1\nlog(s"x = other")', 0),
        ("BrokenInterpolationFieldAccess", "a.scala", 'logger.info(\n s"form $form.id")', 1),
        ("BrokenInterpolationFieldAccess", "a.scala", 'val p = s"$dir.id"', 0),
        ("BrokenInterpolationFieldAccess", "a.scala", 'logger.info(s"form $form.txt ${form.id}")', 0),
        ("StatusRuntimeExceptionForBusinessError", "a.scala", "class A extends StatusRuntimeException(responseStatus = ResponseStatus.NotFound)", 1),
        ("StatusRuntimeExceptionForBusinessError", "a.scala", "class ASystemException extends StatusRuntimeException(responseStatus = ResponseStatus.NotFound)", 0),
        ("StatusRuntimeExceptionForBusinessError", "a.scala", "class A extends StatusRuntimeException(responseStatus = ResponseStatus.Internal)", 0),
        ("TryOptionUnwrappedAccess", "a.scala", "tryLoad.size", 1),
        ("TryOptionUnwrappedAccess", "a.scala", "tryLoad.map(f); tryLoad.size", 0),
    ],
)
def test_scanners(rule, path, text, n):
    assert len(found(rule, path, text)) == n


ADAPTER = "class FooAdapter(client: BarGrpcClient) {\n  def get(id: String)(implicit c: CallScope): X = {\n    visibility.exposing(a) { CALL }\n  }\n  def other() = 1\n}"


def test_adapter_identity(spark):
    rule = "MissingWithAdapterIdentity"
    assert len(found(rule, "a", ADAPTER.replace("CALL", "client.get(id)"))) == 1
    assert not found(rule, "a", ADAPTER.replace("CALL", "signer.withAdapterIdentity { client.get(id) }"))
    assert not found(rule, "a", ADAPTER.replace("CALL", "helper(id)"))
    files = spark.createDataFrame([("a", ADAPTER.replace("CALL", "client.get(id)")), ("b", None), (None, "val Marker = 1")], "path string, text string")
    got = scanners.scan(files, extra=[("G", "low", "(", ["uses Marker here"]), ("N", "low", None, [])]).collect()
    assert {(r.rule, r.file, r.line) for r in got} == {(rule, "a", 2), ("G", None, 1)}


def test_titles_paths_severities(spark):
    df = spark.createDataFrame([("fix: x",), ("[a] Fix y",), ("prefix fix: q",), ("Add z",), ("abc-12 z",), ("prefix",)], "t string")
    assert [r[0] for r in df.select(T.is_fix_title(F.col("t"))).collect()] == [True, True, True, False, True, False]
    paths = spark.createDataFrame([("a/test/B.scala",), ("test/B.scala",), ("a/BTest.scala",), ("a/b.spec.tsx",), ("a/B.scala",)], "p string")
    assert [tuple(r) for r in paths.select(T.is_test_path(F.col("p")), T.is_finding_in_tests(F.col("p")), F.col("p").rlike(T.SCAN_TEST_PATH)).collect()] == [(True, True, True), (False, False, True), (True, True, True), (True, False, False), (False, False, False)]
    sev = spark.createDataFrame([("the author",), ("a style nit",), ("x\n Severity: LOW",), ("plain",)], "t string")
    assert [r[0] for r in sev.select(T.severity_of(F.col("t"))).collect()] == ["high", "low", "low", "medium"]
    assert spark.range(1).select(T.citation_urls(F.lit("see https://h/o/r/pull/12345 and PR 12345, PR-777"), "https://h/o", "r")).first()[0] == ["https://h/o/r/pull/12345", "https://h/o/r/pull/777"]
    assert spark.range(1).select(T.era(F.lit("x"), F.lit("2018-01")), T.era(F.lit(None))).first()[:] == ("2014-2018", "2019-2022")


def test_answers_and_text_parts(spark):
    text = "<rule_id> My-Rule! </rule_id><rule>```yaml\nrules: []\n```</rule><bad>a\n// ---\n\n// ---\nb</bad><good>c</good><rationale>why</rationale>"
    got = corpus.parsed_answer(spark.createDataFrame([(text,), ("<rule_id>x</rule_id>",)], "answer string")).collect()
    assert [(r.rule_id, r.rule_source, r.test_inputs, r.test_outputs) for r in got] == [("my-rule", "rules: []", ["a", "b"], ["c"])]
    row = spark.range(1).select(T.class_name(F.lit("no-null_get")), T.grep_line(F.lit("a.scala:12:x: y")), T.diagnostic(F.lit("[warn] a/B.scala:3:1: warning: [fix.Rule] bad thing")), T.line_at(F.lit("a\nb\nc"), F.lit(5)), T.percent(F.lit(0.125))).first()
    assert row[0] == "NoNullGet" and tuple(row[1]) == ("a.scala", 12, "x: y") and tuple(row[2]) == ("a/B.scala", 3, "medium", "Rule", "bad thing") and row[3] == 3 and row[4] == "12.50%"


def test_upsert_and_append(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 9, "new"), ("c", 3, "z"), ("b", None, "skip"), ("c", 4, "z")], "k string, v int, w string")
    want = {("a", 9, "x"), ("b", 2, "y"), ("c", 4, "z")}
    once = relational.upsert(old, new, ["k"], ["v"], ["v"])
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in relational.upsert(once, new, ["k"], ["v"], ["v"]).collect()}
    assert {tuple(r) for r in relational.append_new(old, new, ["k"], "v").collect()} == {("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")}


def test_ranges_match_brute_force(spark):
    rng = random.Random(1)
    f = [(rng.randrange(3), rng.randrange(2000)) for _ in range(200)]
    r = [(rng.randrange(3), s := rng.randrange(2000), s + rng.choice([0, 5, 700])) for _ in range(15)]
    got = relational.in_ranges(spark.createDataFrame(f, "file int, line int"), spark.createDataFrame(r, "file int, start int, end int")).collect()
    assert sorted((x.file, x.line, x.in_diff) for x in got) == sorted((a, b, any(a == q and s <= b <= e for q, s, e in r)) for a, b in f)


def test_similar_sets_match_brute_force(spark):
    rng = random.Random(2)
    sets = [(i, sorted(rng.sample("abcdefgh", rng.randrange(1, 7)))) for i in range(40)]
    df = spark.createDataFrame(sets, "id int, items array<string>")
    for t in (0.3, 0.6, 1.0):
        got = {(r.left_id, r.right_id) for r in relational.similar_sets(df, df, t, same=True).collect()}
        assert got == {(a, b) for a, x in sets for b, y in sets if a < b and len(set(x) & set(y)) / len(set(x) | set(y)) >= t}


def test_sets_of_all_sizes_match_brute_force(spark):
    """Small sets meet by threes of rare items, large ones and both kinds by one."""
    rng = random.Random(4)
    base = [rng.sample(range(40), n) for n in (2, 3, 4, 8, 11, 13, 16, 22) for _ in range(4)]
    sets = [(i, sorted({f"w{x if rng.random() < 0.85 else rng.randrange(40)}" for x in rng.choice(base)})) for i in range(150)]
    df = spark.createDataFrame(sets, "id int, items array<string>")
    l, r = df.filter("id % 3 = 0"), df.filter("id % 3 > 0")
    for t in (0.3, 0.6, 0.9):
        got = relational.similar_sets(l, r, t)
        want = {(a, b) for a, x in sets for b, y in sets if a % 3 == 0 and b % 3 and len(set(x) & set(y)) / len(set(x) | set(y)) >= t}
        assert {(p.left_id, p.right_id) for p in got.collect()} == want and len(want) > 10
    assert "three" in got._jdf.queryExecution().optimizedPlan().toString()


def test_sets_of_whole_texts_match_brute_force(spark):
    """Large sets around the threshold: neither places nor signatures drop a pair, and few pairs below it are compared."""
    rng = random.Random(6)
    base = [rng.sample(range(900), n) for n in (20, 60, 150, 400) for _ in range(3)]
    sets = []
    for i in range(160):
        kept = rng.uniform(0.6, 1)
        sets.append((i, sorted({f"w{x if rng.random() < kept else rng.randrange(900)}" for x in rng.choice(base)})))
    df = spark.createDataFrame(sets, "id int, items array<string>")
    l, r = df.filter("id % 3 = 0"), df.filter("id % 3 > 0")
    for t in (0.4, 0.6, 0.8):
        got = {(p.left_id, p.right_id) for p in relational.similar_sets(l, r, t).collect()}
        want = {(a, b) for a, x in sets for b, y in sets if a % 3 == 0 and b % 3 and len(set(x) & set(y)) / len(set(x) | set(y)) >= t}
        assert got == want and len(want) > 10


def test_copies_of_a_rule_are_compared_as_one(spark, monkeypatch):
    text = F.concat(F.lit('class R { Term.Name("alpha"); Term.Name("beta"); Term.Name("c'), (F.col("id") % 4).cast("string"), F.lit('") }'))
    rows = spark.range(200).select(F.format_string("p%03d", "id").alias("path"), F.concat(F.lit("C"), "id").alias("class_name"), F.lit(None).cast("string").alias("diagnostic_id"), F.concat(text, F.lit("/*"), "id", F.lit("*/"), F.when(F.col("id") < 4, "x").otherwise("")).alias("text"), "id")
    asked, plain = [], quality.similar_sets
    monkeypatch.setattr(quality, "similar_sets", lambda a, b, t: asked.append((a.count(), b.count())) or plain(a, b, t))
    got = {r.path: r for r in quality.dedup_rules(rows.filter("id < 40"), rows.filter("id >= 40")).collect()}
    assert asked == [(4, 4)]
    alike = [f"C{k}" for k in range(1, 200) if k % 4 == 0]
    assert got["p000"].verdict == "OVERLAP" and got["p000"].overlaps_with == sorted(alike) and got["p000"].jaccard == 1.0
    assert got["p005"].verdict == "EXACT" and got["p005"].overlaps_with == ["C41"]


def test_samples(spark):
    df = spark.range(100)
    one, two = (relational.sampled_seeds(df, 10, s, F.col("id")) for s in (["1"], ["1", "2"]))
    assert {r.id for r in one.collect()} <= {r.id for r in two.collect()} and relational.sampled_seeds(df, 100, ["1"], F.col("id")).count() == 100
    assert [r.id for r in relational.stride(df, 30, F.col("id")).orderBy("id").collect()] == list(range(0, 100, 4))
    assert relational.stride(df, 100, F.col("id")).count() == 100


def test_rule_dedup(spark):
    src = 'class A extends Rule("A") {{ /* c */ Term.Name("alpha"); Type.Name("beta"); x.endsWith("gamma"){} }} // z'
    c = spark.createDataFrame([("c1", "A", None, src.format("")), ("c2", "B", None, src.format('; Term.Name("delta")')), ("c3", "C", "d", 'Term.Name("other")')], "path string, class_name string, diagnostic_id string, text string")
    i = spark.createDataFrame([("i1", "I", None, "/* hi */\n" + src.format("").replace("; ", " ;\n"))], c.schema)
    got = {r.path: (r.verdict, r.overlaps_with) for r in quality.dedup_rules(c, i).collect()}
    assert got["c1"] == ("EXACT", ["I"]) and got["c2"][0] == "OVERLAP" and got["c3"] == ("DISTINCT", [])


def test_gates(spark):
    v = spark.createDataFrame([("a", "scalafix", 0.9, 0.6, 20), ("b", "scalafix", 0.9, 0.6, 21), ("c", "opengrep", 0.85, 0.5, 99), ("d", "opengrep", 0.84, 0.9, 0)], "rule_id string, target string, precision double, recall_in_cluster double, false_positives_on_clean int")
    assert {r.rule_id: r.ship for r in quality.ship_gate(v).collect()} == {"a": True, "b": False, "c": True, "d": False}


def test_spans_inside(spark):
    outer = spark.createDataFrame([("f", 0, 10)], "file string, begin int, stop int")
    inner = spark.createDataFrame([("f", 2, 5), ("f", 8, 12), ("g", 2, 5)], "file string, begin int, stop int")
    assert rules.inside(outer, inner).count() == 1 and rules.inside(outer, inner, negate=True).count() == 2


def test_hdbscan_finds_blobs():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.05, (30, 2)) for c in ((0, 0), (3, 0), (0, 3))] + [rng.uniform(-8, 8, (6, 2)) + 20])
    for leaf in (False, True):
        labels = hdbscan.labels_of(x, 8, 3, leaf)
        for k in range(3):
            own = labels[30 * k : 30 * k + 30]
            assert len(set(own[own >= 0])) >= 1 and (leaf or (own == own[0]).mean() > 0.9)
        assert set(labels[:30]).isdisjoint(set(labels[30:60]) - {-1})
    assert (hdbscan.labels_of(x[:4], 5) == -1).all()


def test_spanning_tree_is_least():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, 1)[:, 1]
    reach = np.maximum(np.maximum(d, core[:, None]), core[None])
    pairs, top, total = sorted((reach[i, j], i, j) for i in range(12) for j in range(i)), list(range(12)), 0.0
    for w, i, j in pairs:
        a, b = top[i], top[j]
        if a != b:
            total, top = total + w, [a if t == b else t for t in top]
    assert abs(hdbscan.spanning_tree(x, 2)[:, 2].sum() - total) < 1e-9


def test_cluster_numbers_per_group(spark):
    rows = [("a", i, 0) for i in range(5)] + [("b", 9, 0)] + [("c", i, i % 2 - 1) for i in range(6)]
    got = hdbscan.numbered(spark.createDataFrame(rows, "g string, id int, label int"), ["g"]).collect()
    assert {(r.g, r.cluster_id) for r in got if r.g != "b"} == {("a", 0), ("c", -1), ("c", 1000)}


def test_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 0.0])], "id int, vector array<double>")
    c = spark.createDataFrame([(7, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [0.0, 1.0])], "k int, centroid array<double>")
    assert {r.id: r.k for r in vectorise.nearest(v, c, "k", 0.8).collect()} == {1: 5, 2: 6, 3: None}
    got = spark.range(1).select(V.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")), V.unit_distance(F.lit(1.0))).first()
    assert tuple(got) == (0.0, 0.0)
    grams = spark.range(1).select(vectorise.ngrams(F.array(*map(F.lit, "abc")), 1, 2), vectorise.char_ngrams(F.lit("Ab c"), 3, 4)).first()
    assert grams[0] == ["a", "b", "c", "a b", "b c"] and grams[1] == [" ab", "ab ", " c ", " ab ", " c "]


def test_patterns_and_reports(spark):
    rows = [("a", f"timezone crash {i}") for i in range(6)] + [("b", f"crash timezone {i}") for i in range(2)] + [("b", f"other words {i}") for i in range(9)] + [("a", f"nothing {i}") for i in range(16)] + [("a", None)]
    got = report.cross_patterns(spark.createDataFrame(rows, "repo string, summary string"), "a", "b", 5, 2).collect()
    assert [(r.token, r.n_a, r.n_b, r.rank) for r in got] == [("crash", 6, 2, 1), ("timezone", 6, 2, 2)]
    stamps = spark.createDataFrame([("2024-01-31T23:30:00-02:00",), ("2024-02-01T00:30:00+00:00",)], "s string")
    w = report.high_watermark(stamps, "s").first()
    assert (w.by_text, w.by_time) == ("2024-02-01T00:30:00+00:00", "2024-01-31T23:30:00-02:00")
    assert {r.month for r in report.monthly(stamps, "s").collect()} == {"2024-01", "2024-02"}


def test_blame(spark):
    deleted = spark.createDataFrame([("B1", "f", "a.scala", 1, "x"), ("B1", "f", "a.scala", 2, "y"), ("B2", "g", "a.md", 1, "z"), ("B3", "h", "b.py", 1, "q")], "bug_key string, fix_sha string, file string, line int, content string")
    blame = spark.createDataFrame([("f", "a.scala", 1, "s1"), ("f", "a.scala", 2, "s2"), ("h", "b.py", 1, "s3")], "fix_sha string, file string, line int, sha string")
    commits = spark.createDataFrame([("s1", 1, 5, 0), ("s2", 1, 5, 0), ("s3", 0, 5, 5)], "sha string, n_files int, insertions int, deletions int")
    assert {(r.bug_key, r.start_line, r.szz_confidence) for r in corpus.blamed(deleted, blame, commits).collect()} == {("B1", 1, 0.7), ("B1", 2, 0.7)}


def test_terms_are_counted_once(spark):
    """The vocabulary and the weights read one shuffle of the same counts."""
    from bugloom.operators import vectorise

    docs = spark.createDataFrame([(1, "a b b"), (2, "a c"), (1, "b"), (3, "")], "id long, text string")
    got = vectorise.tfidf(docs, F.split("text", " "), 3, 1)
    rows = {(r.id, r.term): round(r.weight, 6) for r in got.collect()}
    assert {(1, "a"), (1, "b"), (2, "a")} <= set(rows) and abs(sum(v * v for (i, _), v in rows.items() if i == 1) - 1) < 1e-5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("explode(") == 1 and "ReusedExchange" in plan


def test_view_shuffles_sums_only(spark):
    """The view is that of the matrix, by id, and no round joins rows with vectors."""
    from bugloom.operators import vectorise

    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(rng.choices("abcdefgh", k=9))) for i in range(60)], "id long, text string")
    got = vectorise.svd_view(docs, F.split("text", " "), 8, 40)
    w = {(r.id, r.term): r.weight for r in vectorise.tfidf(docs, F.split("text", " "), 8, 1).collect()}
    m = np.array([[w.get((i, t), 0.0) for t in "abcdefgh"] for i in range(60)])
    xy = np.array([(r.x, r.y) for r in got.orderBy("id").collect()])
    assert np.allclose(np.sort((xy * xy).sum(0)), np.sort(np.linalg.svd(m)[1][:2] ** 2), rtol=1e-4)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]


def test_counted_deals_rows_out_by_the_whole_key(spark, monkeypatch):
    """Rows joined by a part of the key aren't all counted in its task: 900 rows of one bug go to several."""
    monkeypatch.setattr(relational, "COUNTED", 100)
    rows = spark.range(900).selectExpr("concat('b', id % 1) AS bug", "CAST(id % 300 AS STRING) AS path").repartition(2, "bug")
    got = relational.counted(rows, ["bug", "path"], 900)
    assert got.rdd.getNumPartitions() == 9 and max(got.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 100
    assert {(r.bug, r.path, r.n) for r in got.collect()} == {("b0", str(i), 3) for i in range(300)}
    assert relational.counted(rows.limit(0), ["bug", "path"], 0).count() == 0
