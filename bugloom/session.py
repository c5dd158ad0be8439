"""A session with the settings that the engine expects; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "bugloom", **conf: str) -> SparkSession:
    """Adaptive plans, UTC, Arrow.  Shuffle partitions are left to adaptive coalescing from a high start."""
    builder = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.files.maxPartitionBytes": "128m",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def table(spark: SparkSession, name: str, at: str):
    return spark.read.parquet(f"{at}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one in local mode only."""
    import tempfile

    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="bugloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")
