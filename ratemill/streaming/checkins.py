"""Streaming path for wellness check-ins and for watching source files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill import fixed
from ratemill.plans.publish import changed
from ratemill.sources.files import hash_files
from ratemill.streaming.sinks import UpsertTable

CHECKIN = "activity_id bigint, enrollment_id bigint, activity_ts timestamp, activity_type string, verified_flag string"


def read_checkins(spark: SparkSession, path: str, schema: str = CHECKIN, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def valid_checkins(stream: DataFrame, enrollments: DataFrame, allowed=tuple(fixed.ACTIVITY_TYPES)) -> DataFrame:
    """Verified check-ins of an allowed type whose enrollment exists."""
    ok = stream.where(F.col("activity_type").isin(*allowed) & (F.col("verified_flag") == "Y"))
    return ok.join(enrollments.select("enrollment_id").distinct(), "enrollment_id", "left_semi")


def dedupe(stream: DataFrame, delay: str = "1 day", key: str = "activity_id", ts: str = "activity_ts") -> DataFrame:
    """Each key once, remembering keys as long as the watermark delay."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def running_counts(stream: DataFrame, window: str = "1 day", ts: str = "activity_ts", delay: str | None = None) -> DataFrame:
    """Verified count per enrollment and tumbling window.

    With a ``delay`` the windows end: one that lies that long before the latest event seen takes no more events and leaves the state. Of
    windows that changed, update mode then sends the new counts (``upserted`` keeps them).
    """
    stream = stream.withWatermark(ts, delay) if delay else stream
    return stream.groupBy(F.window(ts, window).alias("w"), "enrollment_id").agg(
        F.count(F.lit(1)).alias("qualifying_activity_count")).select(
        F.col("w.start").alias("window_start"), "enrollment_id", "qualifying_activity_count")


def threshold_alarm(stream: DataFrame, n: int = 10_000, window: str = "1 hour", ts: str = "activity_ts", delay: str | None = None) -> DataFrame:
    """Windows whose verified events reach n; windows end as in ``running_counts``, and an alarm is sent when it is reached."""
    stream = stream.withWatermark(ts, delay) if delay else stream
    return stream.groupBy(F.window(ts, window).alias("w")).agg(F.count(F.lit(1)).alias("events")).where(
        F.col("events") >= n).select(F.col("w.start").alias("window_start"), "events")


def upserted(counts: DataFrame, table: UpsertTable, checkpoint: str):
    """Starts a query that keeps the windows of a running count in ``table``, by batch; it ends when all there is has been read."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id)

    return counts.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def source_watch(spark: SparkSession, path: str, known_states: Callable[[], DataFrame],
                 on_change: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a query that hashes new source files, as ``source_state`` does, and passes those with a new hash to ``on_change``."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.schema(schema).format("binaryFile").load(path).select(
        F.col("path").alias("source_path"), F.col("length").alias("byte_size"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        on_change(changed(known_states(), hash_files(batch)).where("changed"), batch_id)

    return files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
