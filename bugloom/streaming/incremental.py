"""Incremental upkeep as streams: first-seen keys, routing to clusters, clusters that become large enough, upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.vectors import cosine


def path_pattern(path: str) -> str:
    """A pattern that matches the path alone: a file stream takes a folder or a pattern, no single file."""
    path = path.rstrip("/")
    return path if set("*?[{") & set(path) else f"{path[:-1]}[{path[-1]}]"


def table_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A stream of the Parquet files of one table in a folder: one file, or a folder of its own."""
    path = f"{folder}/{table}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path_pattern(path))


def at_utc(stamp: Column) -> Column:
    """Watermarks need a timestamp with a zone."""
    return stamp.cast("timestamp")


def first_seen(events: DataFrame, key: list[str], stamp: str | None = None, delay: str = "1 day") -> DataFrame:
    """The first event of each key; with a stamp, state older than the delay goes."""
    if stamp is None:
        return events.dropDuplicates(key)
    return events.withColumn(stamp, at_utc(F.col(stamp))).withWatermark(stamp, delay).dropDuplicatesWithinWatermark(key)


def since(rows: DataFrame, stamp: str, watermark: str | None) -> DataFrame:
    """Rows after the last one that is known; the boundary itself counts again and is removed by key on append."""
    return rows if watermark is None else rows.filter(F.col(stamp) >= watermark)


def windowed_counts(events: DataFrame, stamp: str, key: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    return events.withColumn(stamp, at_utc(F.col(stamp))).withWatermark(stamp, delay).groupBy(F.window(stamp, width), key).count()


def routed(vectors: DataFrame, centroids: DataFrame, threshold: float, actionable: int) -> DataFrame:
    """route of each arriving vector: regression (its cluster has a rule), synthesise (the cluster is large enough), wait, or batch.

    vectors: id, vector, a stream; centroids: cluster_id, centroid, size, has_rule, static and small: one row for each
    cluster is folded into one array, so that the join keeps no state.
    """
    packed = centroids.agg(F.sort_array(F.collect_list(F.struct("cluster_id", F.col("centroid").cast("array<double>").alias("centroid"), "size", "has_rule"))).alias("cs"))
    best = F.array_max(F.transform("cs", lambda c: F.struct(F.coalesce(cosine(F.col("vector"), c["centroid"]), F.lit(-1.0)).alias("cos"), (-c["cluster_id"]).alias("k"), c["size"].alias("size"), c["has_rule"].alias("has_rule"))))
    rows = vectors.crossJoin(F.broadcast(packed)).withColumn("b", best)  # one row
    near = F.col("b.cos") >= threshold
    route = F.when(~near | F.col("b").isNull(), "batch").when(F.col("b.has_rule"), "regression").when(F.col("b.size") >= actionable, "synthesise").otherwise("wait")
    return rows.select("id", F.when(near, -F.col("b.k")).alias("cluster_id"), route.alias("route"))


def threshold_crossings(members: DataFrame, key: str, least: int) -> DataFrame:
    """A row when a key's members reach least, once, over the stream's whole life.  State: a count for each key."""
    kind = members.schema[key].dataType.simpleString()

    def count(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get[0] if state.exists else 0
        new = old + sum(map(len, batches))
        state.update((new,))
        if old < least <= new:
            yield pd.DataFrame({key: [k[0]], "n": [new]})

    return members.groupBy(key).applyInPandasWithState(count, f"`{key}` {kind}, n long", "n long", "append", GroupStateTimeout.NoTimeout)


#: The store that keeps state of processors with timers.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def runs_reaching(events: DataFrame, key: str, stamp: str, least: int, gap_seconds: int, delay: str = "1 hour") -> DataFrame:
    """A row when a key's run of events reaches `least`: key, since and at (microseconds).  A longer gap begins a new run.

    State is one run for each key; a timer removes it once the watermark is past its last event by the gap, so that keys
    which have gone quiet cost nothing.  What comes out doesn't depend on how a stream in order is cut into batches.
    """
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    name, kind = key, events.schema[key].dataType.simpleString()
    gap = gap_seconds * 1_000_000

    class Runs(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle, self.run = handle, handle.getValueState("run", "since long, last long, n long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            at = np.sort(np.concatenate([r["at"].to_numpy(np.int64) for r in rows]))
            since, last, n = self.run.get() if self.run.exists() else (at[0], at[0], 0)
            breaks = np.flatnonzero(np.diff(at, prepend=last) > gap)
            found = []
            for a, b in zip([0, *breaks], [*breaks, len(at)], strict=True):
                if a in breaks:
                    since, n = at[a], 0
                if n < least <= n + b - a:
                    found.append((key[0], int(since), int(at[a + least - n - 1])))
                n += b - a
            last = max(int(last), int(at[-1]))
            self.run.update((int(since), last, int(n)))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer((last + gap) // 1000 + 1)
            if found:
                yield pd.DataFrame(found, columns=[name, "since", "at"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.run.clear()
            return iter(())

        def close(self) -> None:
            pass

    rows = events.withColumn(stamp, at_utc(F.col(stamp))).filter(F.col(key).isNotNull() & F.col(stamp).isNotNull()).withWatermark(stamp, delay)
    rows = rows.select(key, stamp, F.unix_micros(stamp).alias("at"))
    return rows.groupBy(key).transformWithStateInPandas(Runs(), f"`{key}` {kind}, since long, at long", "Append", "EventTime")


def session_counts(events: DataFrame, stamp: str, key: str, gap: str, delay: str = "1 hour") -> DataFrame:
    """key, window, count of sessions that end after a gap; a stream tells a session once it is closed."""
    return events.withColumn(stamp, at_utc(F.col(stamp))).withWatermark(stamp, delay).groupBy(F.session_window(stamp, gap), key).count()


def with_setting(spark: SparkSession, name: str, value: str, run: Callable[[], None]) -> None:
    """Runs with a setting of the session and puts it back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        run()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, path: str | None = None, mode: str = "append") -> None:
    """Takes what is there, then stops; to a Parquet path, or to a function for each batch."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (w.foreachBatch(each).start() if each else w.format("parquet").option("path", path).start()).awaitTermination()


def merged_into(path: str, changes: DataFrame, batch: int, schema: str, key: list[str], merge: Callable[[str, Column, Column], Column], buckets: int = 64) -> None:
    """Merges a batch's rows, one for each key, into a Parquet table that is partitioned by a hash of the key.

    merge(name, old, new) gives each further column of a key that is there already.  Only partitions that the batch's keys
    fall into are read and replaced (Spark's dynamic overwrite).  Each row says which batch was the last to change it, so
    that a batch that comes again, after a failure between its partitions, changes nothing twice.
    """
    spark = changes.sparkSession
    fields = [f.name for f in spark.createDataFrame([], schema).schema]
    at = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    new = changes.select(*fields).withColumn("bucket", at).persist()
    try:
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        old = merged_rows(spark, path, schema).filter(F.col("bucket").isin(touched))
        o, n = (df.select(*(F.col(c).alias(f"{p}_{c}") for c in df.columns)) for p, df in (("o", old), ("n", new)))
        rows = o.join(n, reduce(lambda x, y: x & y, (F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in ["bucket", *key])), "full")
        is_old, is_new = F.col("o_bucket").isNotNull(), F.col("n_bucket").isNotNull()
        again = is_old & (F.col("o_batch") >= batch)

        def value(c: str) -> Column:
            both = F.col(f"o_{c}") if c in key else merge(c, F.col(f"o_{c}"), F.col(f"n_{c}"))
            return F.when(is_old & is_new & ~again, both).when(is_old, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c)

        stamp = F.when(is_new & ~again, F.lit(batch)).otherwise(F.col("o_batch")).cast("long").alias("batch")
        out = rows.select(*map(value, fields), stamp, F.coalesce("o_bucket", "n_bucket").alias("bucket"))
        out.repartition(len(touched), "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    finally:
        new.unpersist()


def merged_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table of merged_into, with batch and bucket; empty if nothing has been merged."""
    whole = spark.createDataFrame([], f"{schema}, batch long, bucket int")
    try:
        return spark.read.schema(whole.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return whole


def kept_for_batch(routed_rows: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows of vectors that no cluster took, which the next run over everything clusters anew."""
    return rows.join(routed_rows.filter("route = 'batch'").select(F.col("id").alias(key)).distinct(), key, "left_semi")
