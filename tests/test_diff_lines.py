"""Diffs as lines in the JVM against the parser of whole texts, on made and on hostile diffs."""

import random

import pytest

from bugloom.operators import diffs

BITS = ["diff --git a/x b/x", "diff --git a/y z.py b/y z.py", "diff --git a/a b/c b/d b/e", "diff --git broken", "diff --git a/ b/", "@@ -1 +3 @@", "@@ -5,2 +7,4 @@ f() {", "@@ -9,2 +9,0 @@", "@@ no range", "@@ -1 +99999999999,2 @@", "--- a/x", "--- /dev/null", "--- ", "+++ b/y", "+++ /dev/null", "+++  b/sp ace.c\t", "+++ b/", "-old", "--dashes", "---dashes", "+new", " same", "", "index 1..2", "\\ No newline", "-\ttab", "Binary files differ", "+++", "--- b"]


def made(rng):
    ends = ["\n"] * 12 + ["\r\n", "\x0b", " ", "\r"]
    return "".join(rng.choice(BITS) + rng.choice(ends) for _ in range(rng.randint(0, 25)))[: None if rng.random() < 0.5 else -1]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return [made(rng) for _ in range(400)] + ["", None, "\n", "diff --git a/x b/x", "diff --git a/x b/x\n@@ -1 +1 @@", "no diff at all\n@@ -1 +1 @@\n-x"]


@pytest.fixture(scope="module")
def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, diff string").repartition(4)


@pytest.mark.parametrize("pull", [True, False])
def test_files(table, texts, pull):
    parse = diffs.files_of_pull if pull else diffs.files_of_show
    want = [(i, k, *f) for i, t in enumerate(texts) for k, f in enumerate(parse(t))]
    got = sorted((r.id, r.ord, r.path, r.body, r.removed) for r in diffs.parsed(table, pull, ["id"]).collect())
    assert got == want and len(got) > 100


def test_ranges(table, texts):
    want = [(i, *r) for i, t in enumerate(texts) for r in diffs.ranges_of(t) if r[1] < 1 << 31]
    got = sorted((r.id, r.ord, r.file, r.start, r.end) for r in diffs.added_ranges(table, ["id"]).collect())
    assert [(i, *r) for i, _, *r in got] == want and len(got) > 50
    assert [k for _, k, *_ in got] == [sum(1 for x in want[:n] if x[0] == w[0]) for n, w in enumerate(want)]


def test_paths_with_spaces_and_kept_columns(spark):
    d = spark.createDataFrame([(1, "r", "diff --git a/y z.py b/y z.py\n@@ -1 +1,2 @@\n-x\n+y")], "id int, repo string, diff string")
    assert [tuple(r) for r in diffs.added_ranges(d, ["id"]).collect()] == [(1, 0, "y z.py", 1, 2)]
    assert diffs.ranges_of("diff --git a/y z.py b/y z.py\n@@ -1 +1,2 @@") == [("y z.py", 1, 2)]
    assert [tuple(r) for r in diffs.parsed(d, False, ["id"]).collect()] == [(1, "r", 0, "y z.py", "@@ -1 +1,2 @@\n-x\n+y", "x")]


def test_lines_from_elsewhere(spark):
    """Numbered lines needn't come from a text column."""
    lines = spark.createDataFrame([("d", 10, "diff --git a/f b/f"), ("d", 20, "@@ -1 +4 @@"), ("d", 30, "-a"), ("e", 1, "-b")], "k string, pos int, line string")
    assert [tuple(r) for r in diffs.files_in(lines, ["k"], False).collect()] == [("d", 0, "f", "@@ -1 +4 @@\n-a", "a")]
