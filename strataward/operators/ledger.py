"""Metric records and alerts kept as stored tables, one folder per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.operators.layout import archive_partitions
from strataward.operators.suppression import KEYS, WINDOW_MINUTES, suppress_alerts
from strataward.sources import fs, journal
from strataward.sources.files import partition_files, partition_sizes
from strataward.sources.writer import upsert_partitioned

DAY = "day"


def record_rows(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Merge rows into the table by key and the day of ``ts``; a row that is recorded twice is kept once."""
    upsert_partitioned(rows.withColumn(DAY, F.date_format("ts", "yyyyMMdd").cast("int")), path, DAY, keys, (), ["ts"])


def load_rows(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The stored rows, from a day and up to a day if given (``yyyy-mm-dd``); other folders are not read."""
    journal.settle(spark, path)
    stored = spark.read.parquet(path)
    for day, keep in ((first_day, F.col(DAY).__ge__), (last_day, F.col(DAY).__le__)):
        if day is not None:
            stored = stored.where(keep(int(day.replace("-", ""))))
    return stored.drop(DAY)


def trim_rows(spark: SparkSession, path: str, first_day: str) -> int:
    """Delete the folders of earlier days; returns how many. Rows without a time stay."""
    old = partition_sizes(partition_files(spark, path)).where(F.col("value").cast("int") < int(first_day.replace("-", "")))
    return archive_partitions(spark, path, old, "cleanup")


def record_metrics(metrics: DataFrame, path: str) -> None:
    """Add metric rows (``dataset``, ``ts``, ...) to the history."""
    record_rows(metrics, path, ["dataset", "ts"])


def raise_alerts(alerts: DataFrame, path: str, keys: Sequence[str] = KEYS, window_minutes: int = WINDOW_MINUTES) -> None:
    """Store the alerts that are not suppressed, by each other or by stored ones, as not acknowledged.

    Stored alerts are facts: none is judged again, whatever comes later. A late alert is held
    against those up to its own time. Only the days from a window before the oldest
    to the newest of the given alerts are read.
    """
    spark = alerts.sparkSession
    fresh = alerts.withColumn("acknowledged", F.lit(False))
    if fs.has_parquet(spark, path):
        span = fresh.agg(
            F.date_format(F.min(F.col("ts") - F.expr(f"INTERVAL {int(window_minutes)} MINUTES")), "yyyy-MM-dd").alias("first"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last")
        ).first()
        stored = load_rows(spark, path, span["first"], span["last"])
        if span["first"] is None:  # no alert has a time
            stored = spark.read.parquet(path).where(F.col(DAY).isNull()).drop(DAY)
        new = fresh.join(stored.select("alert_id"), "alert_id", "left_anti").select(*stored.columns)
        emitted = suppress_alerts(new, keys, window_minutes, emitted=stored)
    else:
        emitted = suppress_alerts(fresh, keys, window_minutes)
    record_rows(emitted, path, ["alert_id"])


def acknowledge_alerts(spark: SparkSession, path: str, ids: DataFrame) -> None:
    """Mark stored alerts (``alert_id``) as acknowledged; unknown ids change nothing."""
    stored = load_rows(spark, path)
    record_rows(stored.join(ids.select("alert_id").distinct(), "alert_id", "left_semi").withColumn("acknowledged", F.lit(True)), path, ["alert_id"])
