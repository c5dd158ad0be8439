"""Runnable jobs over tables: `python -m jobs.rule_gate`, `python -m jobs.findings_feed`."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("jobs")


def config_of(spark: SparkSession, path: str | None, defaults: dict) -> dict:
    """The settings of a small JSON file over the defaults; a name that isn't among them is an error."""
    if not path:
        return dict(defaults)
    row = spark.read.option("multiLine", True).json(path).first()
    given = {k: v for k, v in (row.asDict() if row else {}).items() if v is not None}
    if unknown := set(given) - set(defaults):
        raise ValueError(f"{path}: unknown settings {sorted(unknown)}")
    return defaults | given


def told(what: str, path: str, df: DataFrame) -> int:
    """Logs and gives the number of rows that a path holds."""
    n = df.count()
    log.info("%s %s rows: %s", what, n, path)
    return n
