"""The jobs over copies of tables: reruns, growing input, interrupted settings, odd rows, the command line."""

import collections
import glob
import json
import os
import re
import subprocess
import sys

import duckdb
import pytest

import jobs
from bugloom.operators import rules
from jobs import findings_feed, rule_gate
from jobs.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def hits(docs):
    """Findings as plain Python has them, for patterns that mean the same there."""
    out = []
    for doc_id, text, lang, source, _ in docs:
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            for r in rules.CATALOGUE:
                if re.search(r.pattern, line.lower()) and not (r.not_pattern and re.search(r.not_pattern, line.lower())):
                    out.append((r.rule if hasattr(r, "rule") else r.name, r.severity, doc_id, i + 1, line.strip(" ")[:200], lang, source))
    return out


def rows(first, n):
    mail = ["write to a.b@c.org", "nothing here", "Licence as is", "license, all rights kept", "at 10.0.0.1 now", 'api_key = "' + "k" * 30 + '"', ""]
    return [(i, "\n".join(mail[(i + k) % len(mail)] for k in range(4)) if i % 9 else None, ["en", "de", None][i % 3], f"src{i % 4}", i) for i in range(first, first + n)]


def as_set(df, columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


FOUND = ("rule", "severity", "file", "line", "snippet", "lang", "source")


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}"


def plain(row):
    return tuple("NULL" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        duck.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    got, want = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(plain, got.select(*want.columns).collect())) == sorted(map(plain, want.fetchall()))
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_feed_takes_only_what_is_new(spark, folder):
    docs, out, mark = f"{folder}/docs", f"{folder}/out", f"{folder}/mark"
    spark.createDataFrame(rows(0, 30), DOCS).repartition(2).write.parquet(docs)
    one = findings_feed.run(spark, docs, out, mark)
    assert one["documents"] == 30 and one["findings"] == len(hits(rows(0, 30)))
    files = {f for f in glob.glob(f"{out[7:]}/findings/**/*.parquet", recursive=True)}
    spark.createDataFrame(rows(30, 25), DOCS).write.mode("append").parquet(docs)
    two = findings_feed.run(spark, docs, out, mark)
    assert two["documents"] == 25
    assert files < {f for f in glob.glob(f"{out[7:]}/findings/**/*.parquet", recursive=True)}  # what is there stays as it is
    want = hits(rows(0, 55))
    assert as_set(findings_feed.findings_of(spark, out), FOUND) == collections.Counter(want)
    before = as_set(findings_feed.output(spark, out), findings_feed.output(spark, out).columns)
    three = findings_feed.run(spark, docs, out, mark)
    assert three["documents"] == 0 and as_set(findings_feed.output(spark, out), findings_feed.output(spark, out).columns) == before
    sources = collections.defaultdict(set)
    for rule, _, _, _, snippet, _, source in want:
        sources[rule, snippet].add(source)
    recurring = {(r.rule, r.snippet): r.n_sources for r in spark.read.parquet(f"{out}/recurring").collect()}
    assert recurring == {k: len(v) for k, v in sources.items() if len(v) >= 3} and recurring


def test_feed_goes_on_after_a_failed_summary(spark, folder, monkeypatch):
    docs, out, mark = f"{folder}/docs", f"{folder}/out", f"{folder}/mark"
    spark.createDataFrame(rows(0, 20), DOCS).write.parquet(docs)
    with monkeypatch.context() as m:
        m.setattr(findings_feed.report, "recurring", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            findings_feed.run(spark, docs, out, mark)
    assert findings_feed.run(spark, docs, out, mark)["documents"] == 0
    assert as_set(findings_feed.findings_of(spark, out), FOUND) == collections.Counter(hits(rows(0, 20)))


def test_feed_of_nothing_and_of_texts_without_findings(spark, folder):
    spark.createDataFrame([(1, "fine", "en", "s", 4), (2, None, None, None, None)], DOCS).write.parquet(f"{folder}/docs")
    for _ in range(2):
        got = findings_feed.run(spark, f"{folder}/docs", f"{folder}/out", f"{folder}/mark")
        assert (got["findings"], got["recurring"]) == (0, 0)
    assert findings_feed.output(spark, f"{folder}/out").count() == 0


def test_gate_verdicts_and_rerun(spark, folder):
    data, out = rows(0, 60), f"{folder}/out"
    spark.createDataFrame(data, DOCS).repartition(3).write.parquet(f"{folder}/docs")
    labels = [(i, 1 if i % 5 == 0 else 0, 0) for i in range(40)] + [(3, 1, 0), (None, 1, 0), (4, None, 0), (999, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels")
    truth = {}
    for i, q, _ in labels:
        if i is not None and q is not None:
            truth[i] = min(q, truth.get(i, q))
    want = hits(data)
    for _ in range(2):
        told = rule_gate.run(spark, f"{folder}/docs", f"{folder}/labels", out)
        assert told == {"documents": 60, "findings": len(want), "gate": len(rules.CATALOGUE)}
        assert as_set(spark.read.schema(rule_gate.FINDINGS).parquet(f"{out}/findings"), FOUND) == collections.Counter(want)
    for r in spark.read.parquet(f"{out}/gate").collect():
        own = [truth[h[2]] for h in want if h[0] == r.rule and h[2] in truth]
        tp, fp = own.count(0), own.count(1)
        assert (r.n, r.tp, r.fp) == (sum(h[0] == r.rule for h in want), tp, fp)
        assert r.passed == ((tp / (tp + fp) if own else 0) >= 0.75)
    only = rule_gate.run(spark, f"{folder}/docs", f"{folder}/labels", out, {"rules": ["license-line", "never-seen"], "min_severity": "medium"})
    assert only["gate"] == 1 and only["findings"] == 0  # what other settings had found is gone
    with pytest.raises(ValueError):
        rule_gate.run(spark, f"{folder}/docs", f"{folder}/labels", out, {"rules": ["no such rule"]})


def test_settings_of_a_file(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"min_sources": 7}))
    assert jobs.config_of(spark, f"file://{tmp_path}/c.json", findings_feed.DEFAULTS) == findings_feed.DEFAULTS | {"min_sources": 7}
    (tmp_path / "d.json").write_text(json.dumps({"typo": 1}))
    with pytest.raises(ValueError, match="typo"):
        jobs.config_of(spark, f"file://{tmp_path}/d.json", findings_feed.DEFAULTS)


def test_command_line(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --driver-memory 1g --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"}
    args = [sys.executable, "-m", "jobs.rule_gate", "--documents", f"{SF}/documents.parquet", "--labels", f"{SF}/labels.parquet", "--out", f"file://{tmp_path}/out", "--config", f"file://{root}/jobs/rule_gate.json"]
    done = subprocess.run(args, env=env, cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert re.search(r"read \d+ rows", done.stderr) and re.search(r"wrote 5 rows: .*gate", done.stderr)
