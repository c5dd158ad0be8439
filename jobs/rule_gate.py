"""Which rules may ship: scans source texts, holds findings against labels, writes findings and a verdict for each rule.

    python -m jobs.rule_gate --documents PATH --labels PATH --out PATH [--config jobs/rule_gate.json]

out/findings is partitioned by lang and rule, out/gate has a row for each rule, also for those without a finding.  A
finding counts for its rule if its document is labelled bad (quality 0), against it if good, and for nothing if there is
no label; of several labels the least counts.  Both tables are replaced whole, so a rerun gives the same files' rows.

Settings: rules (names; none: all), min_severity, least_precision.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugloom.operators import quality, rules
from bugloom.session import session

from . import config_of, told

DEFAULTS = {"rules": [], "min_severity": "low", "least_precision": 0.75}
FINDINGS = "severity string, file long, line int, snippet string, source string, good boolean, lang string, rule string"
GATE = "rule string, severity string, n long, tp long, fp long, precision double, passed boolean"


def chosen(names: list[str], least: str) -> tuple[rules.Rule, ...]:
    if unknown := set(names) - {r.name for r in rules.CATALOGUE}:
        raise ValueError(f"unknown rules {sorted(unknown)}")
    order = ("low", "medium", "high")
    return tuple(r for r in rules.CATALOGUE if (not names or r.name in names) and order.index(r.severity) >= order.index(least))


def judged(documents: DataFrame, labels: DataFrame, wanted: tuple[rules.Rule, ...]) -> DataFrame:
    """Findings with their document's lang, source and label."""
    files = documents.select(F.col("doc_id").alias("file"), "lang", "source", "text")
    found = rules.line_findings(files, wanted, keep=("lang", "source"))
    truth = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("file")).agg((F.min("quality") > 0).alias("good"))
    return found.join(truth, "file", "left").select(*(c.split()[0] for c in FINDINGS.split(", ")))


def gate(findings: DataFrame, rule_table: DataFrame, least: float) -> DataFrame:
    hits = findings.filter("good IS NOT NULL").select("rule", (~F.col("good")).alias("positive"))
    judged_rules = quality.precision_gate(hits, rule_table, least)
    return rules.summary(findings, rule_table).join(judged_rules, "rule").select(*(c.split()[0] for c in GATE.split(", ")))


def run(spark: SparkSession, documents: str, labels: str, out: str, config: dict | None = None) -> dict[str, int]:
    """Replaces out/findings and out/gate; tells the rows read and written."""
    settings = DEFAULTS | (config or {})
    wanted = chosen(settings["rules"], settings["min_severity"])
    docs = spark.read.parquet(documents)
    n_read = told("read", documents, docs)
    told("read", labels, spark.read.parquet(labels))
    found = judged(docs, spark.read.parquet(labels), wanted)
    # rebalanced, not repartitioned: adaptive execution splits a language's rule that has most of the findings
    found.hint("rebalance", F.col("lang"), F.col("rule")).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("lang", "rule").parquet(f"{out}/findings")
    findings = spark.read.schema(FINDINGS).parquet(f"{out}/findings")
    n_found = told("wrote", f"{out}/findings", findings)
    gate(findings, rules.rule_table(spark, wanted), settings["least_precision"]).coalesce(1).write.mode("overwrite").parquet(f"{out}/gate")
    return {"documents": n_read, "findings": n_found, "gate": told("wrote", f"{out}/gate", spark.read.schema(GATE).parquet(f"{out}/gate"))}


def output(spark: SparkSession, out: str) -> DataFrame:
    """Both tables as one: part names the table, the columns of the other are null."""
    f, g = spark.read.schema(FINDINGS).parquet(f"{out}/findings"), spark.read.schema(GATE).parquet(f"{out}/gate")
    return f.withColumn("part", F.lit("findings")).unionByName(g.withColumn("part", F.lit("gate")), allowMissingColumns=True)


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("documents", "labels", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config")
    a = p.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = session("rule_gate")
    try:
        run(spark, a.documents, a.labels, a.out, config_of(spark, a.config, DEFAULTS))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
