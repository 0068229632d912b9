"""What date range exists per entity, and where the holes are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataward.functions.dates import as_date, calendar_ordinals, canonical_date_text
from strataward.functions.size import broadcast_if_small


def entity_days(df: DataFrame, code_col: str, date_col: str) -> DataFrame:
    """Rows per code and day. After this a code has at most one row per day, however hot it is."""
    return df.groupBy(F.col(code_col).alias("code"), as_date(df, date_col).alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _gap_columns(days: DataFrame, calendar: DataFrame | None) -> DataFrame:
    """Add the missing run after each day: gap_start, gap_end, gap_days (null when none)."""
    w = Window.partitionBy("code").orderBy("d")
    after = F.lead("d").over(w)
    if calendar is None:
        out = days.withColumn("_next", F.when(F.col("d").isNotNull(), after))
        missing = F.date_diff("_next", "d") - 1
        start, end = F.date_add("d", 1), F.date_sub("_next", 1)
    else:
        cal = broadcast_if_small(calendar_ordinals(calendar).withColumnRenamed("cal_date", "d"))
        joined = days.join(cal, "d", "left")
        nxt = F.lead(F.struct("d", "open_upto", "is_open", "prev_open")).over(w)
        out = joined.withColumn("_next", F.when(F.col("d").isNotNull(), nxt))
        missing = F.col("_next.open_upto") - F.col("_next.is_open") - F.col("open_upto")
        start, end = F.col("next_open"), F.col("_next.prev_open")
    has = missing > 0
    return out.withColumns(
        {
            "gap_start": F.when(has, start),
            "gap_end": F.when(has, end),
            "gap_days": F.when(has, missing).cast("int"),
        }
    )


def coverage(
    df: DataFrame, dataset: str, code_col: str, date_col: str, calendar: DataFrame | None = None
) -> DataFrame:
    """Per code: first and last day, rows, distinct days, missing runs, rows without a usable date.

    Two shuffles: by (code, day) with map-side counts, then by code.
    """
    runs = _gap_columns(entity_days(df, code_col, date_col), calendar)
    return runs.groupBy("code").agg(
        F.min("d").alias("min_date"),
        F.max("d").alias("max_date"),
        F.sum("n").alias("record_count"),
        F.count("d").alias("distinct_dates"),
        F.count("gap_start").alias("gap_count"),
        F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("n"))), F.lit(0)).alias("invalid_dates"),
    ).select(F.lit(dataset).alias("dataset"), "*")


def coverage_totals(cov: DataFrame) -> DataFrame:
    """Whole-dataset range and totals from the per-code rows."""
    return cov.groupBy("dataset").agg(
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
        F.sum("record_count").alias("record_count"),
        F.count(F.lit(1)).alias("codes"),
        F.sum((F.col("gap_count") == 0).cast("long")).alias("complete_codes"),
    )


def find_gaps(
    df: DataFrame, dataset: str, code_col: str, date_col: str, calendar: DataFrame | None = None
) -> DataFrame:
    """Missing runs of days per code; with a calendar only its open days count."""
    runs = _gap_columns(entity_days(df, code_col, date_col), calendar)
    return runs.where(F.col("gap_start").isNotNull()).select(
        F.lit(dataset).alias("dataset"), "code", "gap_start", "gap_end", "gap_days"
    )


def completeness(cov: DataFrame) -> DataFrame:
    return cov.select("dataset", "code", "gap_count", (F.col("gap_count") == 0).alias("is_complete"))


def merge_periods(df: DataFrame, keys: Sequence[str], start: str = "period_start", end: str = "period_end") -> DataFrame:
    """Union of day intervals per key; intervals that touch become one.

    Intervals with one start day merge first, so a key orders at most one per day.
    """
    keys = list(keys)
    firsts = df.groupBy(*keys, F.col(start).alias("_s")).agg(F.max(end).alias("_e"))
    w = Window.partitionBy(*keys).orderBy("_s")
    reach = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = firsts.withColumn("_new", F.when(F.col("_s") <= F.date_add(reach, 1), 0).otherwise(1))
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(F.min("_s").alias(start), F.max("_e").alias(end))
        .drop("_island")
    )


def date_coverage(df: DataFrame, dataset: str, date_col: str) -> DataFrame:
    """First, last and number of distinct canonical days."""
    days = df.select(canonical_date_text(date_col).alias("day")).where(F.col("day").isNotNull())
    return days.agg(
        F.min("day").alias("min_day"), F.max("day").alias("max_day"), F.count_distinct("day").alias("distinct_days")
    ).select(F.lit(dataset).alias("dataset"), "*")


def dataset_inventory(df: DataFrame, dataset: str, partition_col: str | None = None) -> DataFrame:
    """Rows, partition values, and the range of every date column."""
    dated = [c for c in df.columns if "date" in c.lower()]
    cells = [
        F.struct(
            F.lit(c).alias("field"), F.min(as_date(df, c)).alias("lo"), F.max(as_date(df, c)).alias("hi")
        )
        for c in dated
    ]
    parts = F.count_distinct(F.col(partition_col)) if partition_col else F.lit(0)
    counts = df.agg(
        F.count(F.lit(1)).alias("record_count"), parts.cast("long").alias("partition_values"),
        *[c.alias(f"r{i}") for i, c in enumerate(cells)],
    )
    ranges = F.array(*[F.col(f"r{i}") for i in range(len(cells))]) if cells else None
    if ranges is None:
        return counts.select(F.lit(dataset).alias("dataset"), "record_count", "partition_values")
    return counts.select(
        F.lit(dataset).alias("dataset"), "record_count", "partition_values", F.inline(ranges)
    ).withColumnsRenamed({"lo": "min_date", "hi": "max_date"})
