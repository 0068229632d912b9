"""Watermark table: how far each dataset has been loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.functions.size import empty_frame
from strataward.sources import fs
from strataward.sources.writer import latest_per_key

SCHEMA = "dataset string, last_update_date date, record_count long, created_at timestamp_ntz, updated_at timestamp_ntz"


def empty_watermarks(spark: SparkSession) -> DataFrame:
    return empty_frame(spark, SCHEMA)


def merge_watermarks(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert by dataset. Fields an update leaves null, and created_at, keep their stored values.

    ``updates``: dataset, last_update_date, record_count, updated_at; the newest
    update of a dataset counts.
    """
    newest = latest_per_key(updates, ["dataset"], [F.col("updated_at").desc_nulls_last(), F.col("last_update_date").desc_nulls_last()])
    old = stored.select("dataset", *[F.col(c).alias(f"_old_{c}") for c in stored.columns if c != "dataset"])
    both = old.join(newest, "dataset", "full_outer")
    pick = lambda c: F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c)
    return both.select(
        "dataset",
        pick("last_update_date"),
        pick("record_count"),
        F.coalesce("_old_created_at", "updated_at").alias("created_at"),
        pick("updated_at"),
    )


def advance_only(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates that do not move a watermark back."""
    old = stored.select("dataset", F.col("last_update_date").alias("_old"))
    return updates.join(old, "dataset", "left").where(
        F.col("_old").isNull() | (F.col("last_update_date") >= F.col("_old"))
    ).drop("_old")


def remove_watermark(stored: DataFrame, dataset: str) -> DataFrame:
    return stored.where(~F.col("dataset").eqNullSafe(dataset))


def watermark_of(stored: DataFrame, dataset: str) -> DataFrame:
    return stored.where(F.col("dataset") == dataset)


def watermark_summary(stored: DataFrame) -> DataFrame:
    """All datasets, most recently updated first."""
    return stored.orderBy(F.col("updated_at").desc_nulls_last(), "dataset")


def watermark_totals(stored: DataFrame) -> DataFrame:
    return stored.agg(
        F.count(F.lit(1)).alias("datasets"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"),
        F.min("last_update_date").alias("oldest"),
        F.max("last_update_date").alias("newest"),
    )


def resume_from(plan: DataFrame, stored: DataFrame, end: str) -> DataFrame:
    """Start of the next load: the day after the watermark, else the planned start.

    ``plan``: dataset, start_date. Datasets already past ``end`` are marked skip.
    """
    last = stored.select("dataset", "last_update_date")
    start = F.coalesce(F.date_add("last_update_date", 1), F.col("start_date"))
    return plan.join(last, "dataset", "left").select(
        "dataset", start.alias("resume_date"), F.lit(end).cast("date").alias("end_date"),
        (start > F.lit(end).cast("date")).alias("skip"),
    )


def load_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """Stored table; the newest complete copy under the path."""
    copies = fs.child_folders(spark, path)
    done = [c for c in copies if fs.exists(spark, f"{path}/{c}/_SUCCESS")]
    if not done:
        return empty_watermarks(spark)
    return spark.read.schema(SCHEMA).parquet(f"{path}/{done[-1]}")


def save_watermarks(df: DataFrame, path: str) -> None:
    """Write the next copy, then drop older ones; a failed write leaves the last copy in use."""
    spark = df.sparkSession
    copies = fs.child_folders(spark, path)
    serial = int(copies[-1].split("=", 1)[1]) + 1 if copies else 1
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/copy={serial:012d}")
    for old in copies:
        fs.delete(spark, f"{path}/{old}")
