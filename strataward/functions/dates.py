"""Date parsing, canonical text, calendars and report periods."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: text layouts accepted as dates, tried in this order
DATE_LAYOUTS = (
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}-\d{1,2}$", "yyyy-M"),
)
# fixed values: words that mark a date column
DATE_WORDS = ("date", "trade", "ann", "period", "end")
OLDEST_DATE = "1900-01-01"


def parse_date(c: Column | str) -> Column:
    """Date from mixed text layouts; a bare YYYYMM quarter month means its last day."""
    text = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    tries = [F.when(text.rlike(rx), F.try_to_date(text, fmt)) for rx, fmt in DATE_LAYOUTS]
    quarter = F.when(
        text.rlike(r"^\d{4}(03|06|09|12)$"), F.last_day(F.try_to_date(text, "yyyyMM"))
    )
    return F.coalesce(*tries, quarter)


def as_date(df: DataFrame, name: str) -> Column:
    """Date of a column whatever its stored type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return parse_date(name)


def canonical_date_text(c: Column | str) -> Column:
    """First eight characters after removing separators; shorter text gives null."""
    bare = F.regexp_replace((F.col(c) if isinstance(c, str) else c).cast("string"), "[-/]", "")
    return F.when(F.length(bare) >= 8, F.substring(bare, 1, 8))


def find_date_column(columns: list[str], words: tuple[str, ...] = DATE_WORDS) -> str | None:
    """First column whose name contains a date word."""
    return next((c for c in columns if any(w in c.lower() for w in words)), None)


def day_range(spark: SparkSession, start: str, end: str, name: str = "cal_date") -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(name)
    )


def weekday_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar that is closed on Saturday and Sunday."""
    return day_range(spark, start, end).withColumn(
        "is_open", F.when(F.dayofweek("cal_date").isin(1, 7), 0).otherwise(1)
    )


def business_days(spark: SparkSession, start: str, end: str, calendar: DataFrame | None = None) -> DataFrame:
    """Open days of the calendar in the range; every day when there is no calendar."""
    if calendar is None:
        return day_range(spark, start, end)
    return calendar.where(
        F.col("cal_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("is_open") == 1)
    ).select("cal_date")


def report_periods(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Quarter ends within [start, end]."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    quarters = F.sequence(F.trunc(lo, "quarter"), F.trunc(hi, "quarter"), F.expr("interval 3 months"))
    return (
        spark.range(1)
        .select(F.explode(quarters).alias("q"))
        .select(F.date_sub(F.add_months("q", 3), 1).alias("period"))
        .where(F.col("period").between(lo, hi))
    )


def quarter_end(c: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(c, "quarter"), 3), 1)


def calendar_ordinals(calendar: DataFrame) -> DataFrame:
    """Per calendar day: open days so far, and the open day before and after it.

    A calendar has one row per day, so this single ordered pass is bounded.
    """
    one = Window.partitionBy(F.lit(0)).orderBy("cal_date")
    before = one.rowsBetween(Window.unboundedPreceding, -1)
    after = one.rowsBetween(1, Window.unboundedFollowing)
    open_day = F.when(F.col("is_open") == 1, F.col("cal_date"))
    return calendar.select(
        "cal_date",
        F.col("is_open").cast("int").alias("is_open"),
        F.sum(F.col("is_open").cast("int")).over(one.rowsBetween(Window.unboundedPreceding, 0)).alias("open_upto"),
        F.last(open_day, ignorenulls=True).over(before).alias("prev_open"),
        F.first(open_day, ignorenulls=True).over(after).alias("next_open"),
    )


def iso(d: date | str) -> str:
    """ISO text of a date given as date, ISO text or yyyyMMdd text."""
    if isinstance(d, date):
        return d.isoformat()[:10]
    return f"{d[:4]}-{d[4:6]}-{d[6:]}" if len(d) == 8 and d.isdigit() else d
