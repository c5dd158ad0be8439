"""Command line: scan a source tree, cluster a corpus, list recurring words."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import functions as F

from ..operators import quality, relational, report, rules, scanners
from ..schemas import CORPUS
from ..session import session
from ..sources import readers, sinks
from . import batch


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bugloom")
    sub = p.add_subparsers(dest="command", required=True)
    scan = sub.add_parser("scan", help="findings of all scanners in a source tree")
    scan.add_argument("root"), scan.add_argument("out"), scan.add_argument("--include", action="append"), scan.add_argument("--exclude", action="append", default=[]), scan.add_argument("--include-tests", action="store_true"), scan.add_argument("--severity", default="low")
    cluster = sub.add_parser("cluster", help="clusters of a corpus whose rows have embeddings, by language and era")
    cluster.add_argument("corpus"), cluster.add_argument("out"), cluster.add_argument("--cap", type=int, default=2), cluster.add_argument("--seed", type=int, default=13), cluster.add_argument("--min-size", type=int, default=5), cluster.add_argument("--min-commits", type=int, default=3)
    words = sub.add_parser("patterns", help="words of fixes that recur in two repositories")
    words.add_argument("corpus"), words.add_argument("--repos", nargs=2, required=True), words.add_argument("out")
    gate = sub.add_parser("gate", help="precision of rules over rows (rule, positive)")
    gate.add_argument("hits"), gate.add_argument("--least", type=float, default=0.75)
    return p


def main(argv: list[str] | None = None) -> int:
    from ..functions import text as T

    a = parser().parse_args(argv)
    spark = session()
    if a.command == "scan":
        files = readers.source_files(spark, a.root, include=a.include or ["**/*.scala"], exclude=a.exclude, tests=a.include_tests)
        found = scanners.scan(files).filter(T.at_least(F.col("severity"), a.severity)).persist()
        names = spark.createDataFrame([(r, scanners.SCANNERS[r][0]) for r in scanners.ACTIVE], "rule string, severity string")
        found.orderBy(T.severity_rank(F.col("severity")), "file", "line").write.mode("overwrite").json(f"{a.out}/findings")
        rules.summary(found, names).write.mode("overwrite").json(f"{a.out}/summary")
        sinks.scan_report(found, a.root, datetime.datetime.now(datetime.UTC).isoformat()).write.mode("overwrite").json(f"{a.out}/report")
    elif a.command == "cluster":
        rows = readers.json_lines(spark, a.corpus, CORPUS).filter("embedding IS NOT NULL")
        entries, labels = batch.clustered_by_era(rows, a.cap, a.seed, a.min_size)
        labels = labels.persist()
        named = entries.join(labels.select("id", "cluster_id"), "id").withColumn("ord", F.col("id")).persist()
        sinks.cluster_bundles(named, a.min_commits).write.mode("overwrite").json(f"{a.out}/bundles")
        summary = report.language_summary(rows, "language", T.is_noise_summary(F.col("bug_summary")), a.cap, "bug_key")
        summary.join(report.cluster_summary(named, "language", "cluster_id", "bug_key", a.min_commits), "language", "left").write.mode("overwrite").json(f"{a.out}/summary")
        labels.unpersist(), named.unpersist()
    elif a.command == "patterns":
        rows = readers.json_lines(spark, a.corpus, CORPUS).select("repo", F.col("bug_summary").alias("summary"))
        report.cross_patterns(rows, *a.repos).orderBy("rank").write.mode("overwrite").json(a.out)
    else:
        hits = readers.json_lines(spark, a.hits, "rule string, positive boolean", strict=True)
        failed = quality.precision_gate(hits, relational.first_of(hits.select("rule"), ["rule"], "rule"), a.least).filter("NOT passed").count()
        return int(failed > 0)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
