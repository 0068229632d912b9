"""Which entity and period must be loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.functions.dates import business_days, iso, report_periods
from strataward.functions.ordered import with_index
from strataward.operators.coverage import merge_periods
from strataward.sources.catalog import NONE, YEAR, DatasetSpec

FIRST_YEAR = 2005  # fixed value: partitions are expected from this year on
EXCHANGES = ("SSE", "SZSE")  # fixed values


def _day(d: str) -> Column:
    return F.lit(iso(d)).cast("date")


def uncovered(have_start: Column, have_end: Column, start: str, end: str) -> Column:
    """Array of requested periods before and after what exists."""
    lo, hi = _day(start), _day(end)
    before = F.struct(lo.alias("period_start"), F.least(F.date_sub(have_start, 1), hi).alias("period_end"))
    after = F.struct(F.greatest(F.date_add(have_end, 1), lo).alias("period_start"), hi.alias("period_end"))
    return F.filter(F.array(before, after), lambda p: p["period_start"] <= p["period_end"])


def missing_periods(
    cov: DataFrame, start: str, end: str, gaps: DataFrame | None = None
) -> DataFrame:
    """Periods of the request that each code lacks; known gaps inside the request count too."""
    ends = cov.select("dataset", "code", F.inline(uncovered(F.col("min_date"), F.col("max_date"), start, end)))
    if gaps is None:
        return ends
    inside = gaps.where((F.col("gap_start") >= _day(start)) & (F.col("gap_end") <= _day(end))).select(
        "dataset", "code", F.col("gap_start").alias("period_start"), F.col("gap_end").alias("period_end")
    )
    return merge_periods(ends.unionByName(inside), ["dataset", "code"])


def plan_loads(
    cov: DataFrame,
    universe: DataFrame,
    dataset: str,
    start: str,
    end: str,
    gap_policy: str = "full",
    gaps: DataFrame | None = None,
) -> DataFrame:
    """Load decision per code, one row per period to load.

    gap_policy "full" reloads a code that has gaps; "missing" loads only the gaps,
    which must then be given.
    """
    if gap_policy not in ("full", "missing"):
        raise ValueError(f"unknown gap policy {gap_policy}")
    if gap_policy == "missing" and gaps is None:
        raise ValueError("gap policy missing needs the gaps")
    have = cov.select(
        "code", F.col("min_date").alias("existing_start"), F.col("max_date").alias("existing_end"),
        "record_count", "gap_count", "invalid_dates", F.lit(True).alias("_have"),
    )
    both = universe.select("code").distinct().join(have, "code", "full_outer")
    gappy = F.col("gap_count") > 0
    full = (
        F.when(F.col("_have").isNull(), "no_existing_data")
        .when(F.col("existing_start").isNull(), "invalid_date_range")
    )
    if gap_policy == "full":
        full = full.when(gappy, "data_gaps_detected")
    flawed = (F.col("invalid_dates") > 0) | gappy
    decided = both.withColumns({"_full": full, "_flawed": flawed})
    whole = F.array(F.struct(_day(start).alias("period_start"), _day(end).alias("period_end")))
    ends = uncovered(F.col("existing_start"), F.col("existing_end"), start, end)
    periods = F.when(F.col("_full").isNotNull(), whole).otherwise(ends)
    if gap_policy == "missing":
        inside = missing_periods(cov.where("gap_count > 0"), start, end, gaps)
        per_code = inside.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("period_start", "period_end"))).alias("_inside"))
        decided = decided.join(per_code, "code", "left")
        periods = F.when(F.col("_full").isNotNull(), whole).otherwise(
            F.when(gappy, F.coalesce("_inside", F.filter(ends, lambda p: F.lit(False)))).otherwise(ends)
        )
    decided = decided.withColumn("_periods", periods)
    some = F.size("_periods") > 0
    action = F.when(F.col("_full").isNotNull(), "full").when(some, "missing").otherwise("skip")
    reason = F.coalesce(
        "_full",
        F.when(some & F.col("_flawed"), "missing_data_with_gaps")
        .when(some, "missing_data_periods")
        .when(F.col("_flawed"), "data_incomplete_but_no_missing_periods")
        .otherwise("data_fully_covered_and_complete"),
    )
    known = F.col("existing_start").isNotNull()
    labelled = decided.select(
        F.lit(dataset).alias("dataset"), "code", action.alias("action"), reason.alias("reason"),
        "existing_start", "existing_end",
        F.when(known, F.col("record_count")).otherwise(F.lit(0)).cast("long").alias("record_count"), "_periods",
    )
    columns = ["dataset", "code", "action", "period_start", "period_end", "reason", "existing_start", "existing_end", "record_count"]
    return labelled.select(
        "*", F.inline_outer("_periods")
    ).select(*columns)


def plan_summary(plan: DataFrame) -> DataFrame:
    """Codes per action."""
    return plan.groupBy("action").agg(F.count_distinct("code").alias("codes"), F.count(F.lit(1)).alias("rows"))


def due_rows(plan: DataFrame, source: DataFrame, code_col: str, date_col: str) -> DataFrame:
    """Rows of a staged source that the plan asks for.

    Joined by code on the few periods of each code; the day test is part of the join.
    """
    wanted = plan.where(F.col("action") != "skip").select(F.col("code").alias("_c"), "period_start", "period_end")
    inside = F.col(date_col).between(F.col("period_start"), F.col("period_end"))
    return source.join(wanted, (F.col(code_col) == F.col("_c")) & inside, "left_semi")


def expand_tasks(
    spark: SparkSession,
    spec: DatasetSpec,
    start: str,
    end: str,
    codes: DataFrame | None = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Load tasks of a dataset by its batch strategy, with batch numbers."""
    lo, hi = _day(start), _day(end)
    strategy = spec.batch_strategy
    nothing = F.lit(None).cast("string")
    if strategy == "by_stock":
        if codes is None:
            raise ValueError(f"{spec.name} is loaded by code and needs the codes")
        rows = with_index(codes.select("code").distinct(), [], ["code"], "_n")
        rows = rows.select("_n", F.col("code").alias("unit"), lo.alias("period_start"), hi.alias("period_end"))
    elif strategy == "by_date":
        days = with_index(business_days(spark, iso(start), iso(end), calendar), [], ["cal_date"], "_n")
        rows = days.select("_n", nothing.alias("unit"), F.col("cal_date").alias("period_start"), F.col("cal_date").alias("period_end"))
    elif strategy == "by_period":
        ends = with_index(report_periods(spark, iso(start), iso(end)), [], ["period"], "_n")
        rows = ends.select("_n", nothing.alias("unit"), F.col("period").alias("period_start"), F.col("period").alias("period_end"))
    elif strategy == "by_exchange":
        units = F.posexplode(F.array(*[F.lit(x) for x in EXCHANGES])).alias("_n", "unit")
        rows = spark.range(1).select(units).select("_n", "unit", lo.alias("period_start"), hi.alias("period_end"))
    else:  # by_month, by_date_range and unnamed strategies load the range at once
        rows = spark.range(1).select(F.col("id").alias("_n"), nothing.alias("unit"), lo.alias("period_start"), hi.alias("period_end"))
    batch = F.floor(F.col("_n") / F.lit(spec.batch_size)).cast("long")
    return rows.select(F.lit(spec.name).alias("dataset"), batch.alias("batch_no"), "unit", "period_start", "period_end")


def first_missing_partition(
    spark: SparkSession, present: DataFrame, granularity: str, as_of: str, first_year: int = FIRST_YEAR
) -> DataFrame:
    """First day of the earliest expected partition that is absent, else the day before ``as_of``.

    ``present``: value (year or yyyymm, as number or text).
    """
    yesterday = F.date_sub(_day(as_of), 1)
    if granularity == NONE:
        any_row = present.limit(1).agg(F.count(F.lit(1)).alias("n"))
        return any_row.select(F.when(F.col("n") > 0, yesterday).otherwise(_day(f"{first_year}-01-01")).alias("first_missing"))
    step, form = ("1 year", "yyyy") if granularity == YEAR else ("1 month", "yyyyMM")
    unit = "year" if granularity == YEAR else "month"
    expected = spark.range(1).select(
        F.explode(F.sequence(_day(f"{first_year}-01-01"), F.trunc(_day(as_of), unit), F.expr(f"interval {step}"))).alias("d")
    ).withColumn("value", F.date_format("d", form))
    have = present.select(F.col("value").cast("string").alias("value")).distinct()
    lost = expected.join(have, "value", "left_anti")
    return lost.agg(F.coalesce(F.min("d"), yesterday).alias("first_missing"))
