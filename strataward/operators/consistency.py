"""Field and logical consistency of one dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.functions.dates import OLDEST_DATE, as_date
from strataward.functions.ordered import ordered
from strataward.functions.size import AUTO, SkewPolicy
from strataward.operators.issues import CountRules, no_issues, union_issues

# fixed values: price columns and required columns per dataset type
PRICE_FIELDS = ("open", "close", "high", "low", "pre_close")
REQUIRED = {
    "stock": ("ts_code", "trade_date", "close"),
    "index": ("ts_code", "trade_date", "close"),
    "financial": ("ts_code", "ann_date", "end_date", "f_ann_date"),
}
REQUIRED_OTHER = ("ts_code", "trade_date")


@dataclass(frozen=True)
class ConsistencyConfig:
    price_bounds: tuple[float, float] = (0.0, 100_000.0)
    volume_bounds: tuple[float, float] = (0.0, 1_000_000_000.0)
    max_change: float = 0.20
    allow_negative_prices: bool = False
    allow_negative_volume: bool = False
    oldest_date: str = OLDEST_DATE


DEFAULTS = ConsistencyConfig()


def date_fields(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower()]


def required_rules(rules: CountRules, df: DataFrame, data_type: str) -> None:
    for c in REQUIRED.get(data_type, REQUIRED_OTHER):
        if c in df.columns:
            rules.add("field", "required_field_null", c, F.col(c).isNull(), f"Required field {c} has {{n}} null values")


def _bounded(rules, c, bounds, negative_check, bounds_check, allow_negative) -> None:
    low, high = bounds
    if not allow_negative:
        rules.add("field", negative_check, c, F.col(c) < 0, f"Field {c} has {{n}} negative values")
    outside = (F.col(c) < low) | (F.col(c) > high)
    rules.add("field", bounds_check, c, outside, f"Field {c} has {{n}} values outside its bounds")


def price_rules(rules: CountRules, df: DataFrame, config: ConsistencyConfig) -> None:
    for c in (f for f in PRICE_FIELDS if f in df.columns):
        _bounded(rules, c, config.price_bounds, "negative_price", "price_bounds", config.allow_negative_prices)


def volume_rules(rules: CountRules, df: DataFrame, config: ConsistencyConfig) -> None:
    if "volume" in df.columns:
        _bounded(rules, "volume", config.volume_bounds, "negative_volume", "volume_bounds", config.allow_negative_volume)


def null_date_rules(rules: CountRules, df: DataFrame) -> None:
    for c in date_fields(df):
        rules.add("field", "null_date", c, F.col(c).isNull(), f"Date field {c} has {{n}} null values")


def broken_high():
    o, h, c = (F.col(x) for x in ("open", "high", "close"))
    return o.isNotNull() & c.isNotNull() & (h < F.greatest(o, c))


def broken_low():
    o, low, c = (F.col(x) for x in ("open", "low", "close"))
    return o.isNotNull() & c.isNotNull() & (low > F.least(o, c))


def ohlc_rules(rules: CountRules, df: DataFrame) -> None:
    if {"open", "high", "low", "close"} <= set(df.columns):
        rules.add("logical", "ohlc_high", "high", broken_high(), "{n} records have a high below open or close")
        rules.add("logical", "ohlc_low", "low", broken_low(), "{n} records have a low above open or close")


def date_bound_rules(rules: CountRules, df: DataFrame, as_of: str, oldest: str = OLDEST_DATE, fields: Sequence[str] | None = None, scope: str = "logical") -> None:
    """Future and very old dates; text that is no date counts as neither."""
    for c in date_fields(df) if fields is None else fields:
        day = as_date(df, c)
        rules.add(scope, "future_date", c, day > F.lit(as_of).cast("date"), f"Date field {c} has {{n}} future dates")
        rules.add(scope, "old_date", c, day < F.lit(oldest).cast("date"), f"Date field {c} has {{n}} very old dates")


def _run(df: DataFrame, dataset: str, *steps) -> DataFrame:
    rules = CountRules(dataset)
    for step, *args in steps:
        step(rules, df, *args)
    return rules.issues(df)


def check_required(df: DataFrame, dataset: str, data_type: str) -> DataFrame:
    return _run(df, dataset, (required_rules, data_type))


def check_price_fields(df: DataFrame, dataset: str, config: ConsistencyConfig = DEFAULTS) -> DataFrame:
    return _run(df, dataset, (price_rules, config))


def check_volume(df: DataFrame, dataset: str, config: ConsistencyConfig = DEFAULTS) -> DataFrame:
    return _run(df, dataset, (volume_rules, config))


def check_null_dates(df: DataFrame, dataset: str) -> DataFrame:
    return _run(df, dataset, (null_date_rules,))


def check_ohlc(df: DataFrame, dataset: str) -> DataFrame:
    return _run(df, dataset, (ohlc_rules,))


def check_date_bounds(df: DataFrame, dataset: str, as_of: str, config: ConsistencyConfig = DEFAULTS) -> DataFrame:
    return _run(df, dataset, (date_bound_rules, as_of, config.oldest_date))


def check_price_change(
    df: DataFrame, dataset: str, order_by: Sequence[str], keys: Sequence[str] = (),
    config: ConsistencyConfig = DEFAULTS, policy: SkewPolicy = AUTO,
) -> DataFrame:
    """Steps of close above the allowed share, row to row within a key.

    Rows that ``order_by`` leaves equal follow by close, so the count is one and the same in every run.
    """
    if "close" not in df.columns:
        return no_issues(df.sparkSession)
    narrow = df.select(*dict.fromkeys([*keys, *order_by, "close"]))
    o = ordered(narrow, keys, list(dict.fromkeys([*order_by, "close"])), halo=1, policy=policy)
    before = F.lag("close").over(o.window)
    stepped = o.finish(o.df.withColumn("_change", F.abs(F.try_divide(F.col("close") - before, before))))
    rules = CountRules(dataset)
    rules.add("logical", "price_change", "close", F.col("_change") > config.max_change,
              f"Close changes by more than {config.max_change:.0%} in {{n}} records")
    return rules.issues(stepped)


def validate_consistency(
    df: DataFrame,
    dataset: str,
    data_type: str,
    as_of: str,
    order_by: Sequence[str] = (),
    keys: Sequence[str] = (),
    config: ConsistencyConfig = DEFAULTS,
    policy: SkewPolicy = AUTO,
) -> DataFrame:
    """Every check of one dataset as issue rows.

    All counting rules share one aggregate over the scan; only the step check
    needs an order, on three columns.
    """
    flat = _run(
        df, dataset, (required_rules, data_type), (price_rules, config), (volume_rules, config), (null_date_rules,),
        (ohlc_rules,), (date_bound_rules, as_of, config.oldest_date),
    )
    frames = [flat]
    if order_by:
        frames.append(check_price_change(df, dataset, order_by, keys, config, policy))
    return union_issues(df.sparkSession, frames)


def verdict(issues: DataFrame, total: DataFrame) -> DataFrame:
    """One row: validity, records and number of failed checks. ``total`` holds total_records."""
    found = issues.agg(F.count(F.lit(1)).alias("n"))
    return total.select(
        F.col("total_records").cast("long").alias("total_records"),
        found.scalar().alias("failed_checks"),
        (found.scalar() == 0).alias("overall_valid"),
    )


