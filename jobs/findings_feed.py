"""Feeds findings from new source texts, and what recurs across repositories.

    python -m jobs.findings_feed --documents PATH --out PATH --checkpoint PATH [--config jobs/findings_feed.json]

Takes the Parquet files that have come since the last run (a file stream with a checkpoint), scans their lines and appends
to out/findings, partitioned by severity and rule.  Then out/recurring is made anew of all findings: what stands in
min_sources repositories or more, the same text of the same rule.  A run without new files changes nothing; a run that
broke off goes on from its checkpoint.

Settings: min_severity, min_sources, files_per_batch.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugloom.functions import text as T
from bugloom.operators import report, rules
from bugloom.session import session
from bugloom.streaming import incremental

from . import config_of, log, told

DEFAULTS = {"min_severity": "low", "min_sources": 3, "files_per_batch": 1000}
FINDINGS = "file long, line int, snippet string, lang string, source string, severity string, rule string"
RECURRING = "rule string, snippet string, n long, n_sources long, first_file long, n_langs long"


def found_in(documents: DataFrame, least: str) -> DataFrame:
    """Findings of rules of at least that severity; documents may be a stream."""
    files = documents.select(F.col("doc_id").alias("file"), "lang", "source", "text")
    found = rules.line_findings(files, keep=("lang", "source"))
    return found.filter(T.at_least(F.col("severity"), least)).select(*(c.split()[0] for c in FINDINGS.split(", ")))


def taken(spark: SparkSession, documents: str, out: str, checkpoint: str, settings: dict) -> int:
    """Appends the findings of files that are new; gives the number of documents in them."""
    schema = spark.read.parquet(documents).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings["files_per_batch"]).parquet(incremental.path_pattern(documents))
    found = found_in(stream, settings["min_severity"])
    seen = []

    def drained() -> None:
        query = found.writeStream.format("parquet").partitionBy("severity", "rule").option("path", f"{out}/findings").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))

    incremental.with_setting(spark, "spark.sql.streaming.numRecentProgressUpdates", "1000000", drained)  # else rows of the last 100 batches
    return seen[0]


def findings_of(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(FINDINGS).parquet(f"{out}/findings")


def run(spark: SparkSession, documents: str, out: str, checkpoint: str, config: dict | None = None) -> dict[str, int]:
    """One run; tells the rows read and those that the tables hold now."""
    settings = DEFAULTS | (config or {})
    n_read = taken(spark, documents, out, checkpoint, settings)
    log.info("read %s new rows: %s", n_read, documents)
    n = told("holds", f"{out}/findings", findings_of(spark, out))
    report.recurring(findings_of(spark, out), ["rule", "snippet"], "source", "file", settings["min_sources"], "lang").write.mode("overwrite").parquet(f"{out}/recurring")
    return {"documents": n_read, "findings": n, "recurring": told("wrote", f"{out}/recurring", spark.read.schema(RECURRING).parquet(f"{out}/recurring"))}


def output(spark: SparkSession, out: str) -> DataFrame:
    """Both tables as one: part names the table, the columns of the other are null."""
    recurring = spark.read.schema(RECURRING).parquet(f"{out}/recurring")
    return findings_of(spark, out).withColumn("part", F.lit("findings")).unionByName(recurring.withColumn("part", F.lit("recurring")), allowMissingColumns=True)


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("documents", "out", "checkpoint"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config")
    a = p.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = session("findings_feed")
    try:
        run(spark, a.documents, a.out, a.checkpoint, config_of(spark, a.config, DEFAULTS))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
