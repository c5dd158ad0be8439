"""The jobs as queries: each runs twice over the whole tables into one new folder; what the second run leaves is returned."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from bugloom.catalog import LINES, RULES_SQL
from bugloom.session import shared_folder

from . import findings_feed, rule_gate


def _folder(spark: SparkSession, job: str) -> str:
    return f"{shared_folder(spark)}/{job}-{uuid.uuid4().hex}"


def job1_rule_gate(spark: SparkSession, at: str) -> DataFrame:
    out = _folder(spark, "job1-rule-gate")
    for _ in range(2):
        rule_gate.run(spark, f"{at}/documents.parquet", f"{at}/labels.parquet", out)
    return rule_gate.output(spark, out)


def job2_findings_feed(spark: SparkSession, at: str) -> DataFrame:
    out = _folder(spark, "job2-findings-feed")
    for _ in range(2):
        findings_feed.run(spark, f"{at}/documents.parquet", f"{out}/tables", f"{out}/checkpoint")
    return findings_feed.output(spark, f"{out}/tables")


_HITS = f"""(SELECT rule, severity, doc_id AS file, CAST(line AS INTEGER) AS line, left(trim(value, ' '), 200) AS snippet, lang, source FROM {LINES} l, {RULES_SQL} r
  WHERE regexp_matches(lower(value), pattern) AND (not_pattern IS NULL OR NOT regexp_matches(lower(value), not_pattern)))"""
QUERIES = {"job1_rule_gate": job1_rule_gate, "job2_findings_feed": job2_findings_feed}
ORACLE_SQL = {
    "job1_rule_gate": f"""WITH truth AS (SELECT doc_id AS file, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
  found AS (SELECT h.*, good FROM {_HITS} h LEFT JOIN truth USING (file)),
  counted AS (SELECT r.rule, r.severity, count(file) AS n, count(file) FILTER (WHERE NOT good) AS tp, count(file) FILTER (WHERE good) AS fp FROM {RULES_SQL} r LEFT JOIN found f ON f.rule = r.rule GROUP BY r.rule, r.severity)
  SELECT 'findings' AS part, * FROM found UNION ALL BY NAME
  SELECT 'gate' AS part, *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END >= {rule_gate.DEFAULTS["least_precision"]} AS passed FROM counted""",
    "job2_findings_feed": f"""WITH found AS (SELECT * FROM {_HITS})
  SELECT 'findings' AS part, * FROM found UNION ALL BY NAME
  SELECT 'recurring' AS part, rule, snippet, count(*) AS n, count(DISTINCT source) AS n_sources, min(file) AS first_file, count(DISTINCT lang) AS n_langs FROM found GROUP BY rule, snippet HAVING count(DISTINCT source) >= {findings_feed.DEFAULTS["min_sources"]}""",
}
