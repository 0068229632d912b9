"""Metrics, trends and alerts over quality results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataward.operators.score import quality_score


@dataclass(frozen=True)
class Thresholds:
    quality_score: float = 0.8
    anomaly_rate: float = 0.05
    consistency_issues: float = 10
    integrity_issues: float = 5


DEFAULTS = Thresholds()
TREND_STEP = 0.01


def _ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def extract_metrics(issues: DataFrame, totals: DataFrame, ts: str) -> DataFrame:
    """One metrics row per dataset. ``totals``: dataset, total_records."""
    check = F.lower("check")
    is_null, is_bound = check.contains("null"), check.contains("bounds")
    is_anomaly = check.contains("anomaly")
    rows = issues.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total_issues"),
        F.sum(F.when(is_anomaly & ~is_null & ~is_bound, F.col("count"))).alias("anomaly_count"),
        F.count_if(F.col("scope") == "logical").alias("consistency_issues"),
        F.count_if(F.col("scope") == "referential").alias("integrity_issues"),
        F.sum(F.when(is_null, F.col("count"))).alias("null_count"),
        F.sum(F.when(is_bound & ~is_null, F.col("count"))).alias("bounds_violations"),
    )
    names = ["total_issues", "anomaly_count", "consistency_issues", "integrity_issues", "null_count", "bounds_violations"]
    both = totals.join(rows, "dataset", "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in names})
    return both.select(
        "dataset", _ts(ts).alias("ts"),
        quality_score(F.col("total_issues"), F.col("total_records")).alias("quality_score"),
        *names[:4], "total_records", *names[4:],
    )


def threshold_alerts(metrics: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Alerts for metrics beyond their thresholds; four rules per metrics row."""
    rate = F.coalesce(F.try_divide("anomaly_count", "total_records"), F.lit(0.0))
    rules = (
        ("quality_score", "high", F.col("quality_score"), thresholds.quality_score, "below"),
        ("anomaly_rate", "medium", rate, thresholds.anomaly_rate, "above"),
        ("consistency_issues", "medium", F.col("consistency_issues"), thresholds.consistency_issues, "above"),
        ("integrity_issues", "high", F.col("integrity_issues"), thresholds.integrity_issues, "above"),
    )
    cells = []
    for name, severity, value, limit, side in rules:
        value = value.cast("double")
        cells.append(
            F.struct(
                F.lit(name).alias("alert_type"), F.lit(severity).alias("severity"), F.lit(name).alias("metric"),
                value.alias("value"), F.lit(float(limit)).alias("threshold"),
                F.concat(F.lit(f"{name} of "), "dataset", F.lit(f" is {side} its threshold {limit:g}")).alias("message"),
                ((value < limit) if side == "below" else (value > limit)).alias("_hit"),
            )
        )
    rows = metrics.select("dataset", "ts", F.inline(F.array(*cells))).where("_hit")
    ident = F.sha2(F.concat_ws("|", "alert_type", "dataset", "severity", F.col("ts").cast("string")), 256)
    return rows.select(
        F.substring(ident, 1, 16).alias("alert_id"), "alert_type", "severity", "dataset", "metric", "value", "threshold", "message", "ts"
    )


def trend_label(first: Column, last: Column, n: Column, higher_is_better: bool = True) -> Column:
    change = (last - first) if higher_is_better else (first - last)
    return (
        F.when(n < 2, "insufficient_data")
        .when(change > TREND_STEP, "improving")
        .when(change < -TREND_STEP, "degrading")
        .otherwise("stable")
    )


def quality_trends(
    history: DataFrame, as_of: str, days: int = 7, value: str = "quality_score", higher_is_better: bool = True, overall: bool = True
) -> DataFrame:
    """First, last, change, average and label per dataset over the last days; ``*`` is all datasets."""
    recent = history.where(F.col("ts") >= _ts(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
    v = F.col(value).cast("double")

    def rolled(frame: DataFrame, by: list) -> DataFrame:
        order = F.struct("ts", "dataset")
        return frame.groupBy(*by).agg(
            F.count(F.lit(1)).alias("points"), F.min_by(v, order).alias("first_value"),
            F.max_by(v, order).alias("last_value"), F.avg(v).alias("average_value"),
        )

    out = rolled(recent, ["dataset"])
    if overall:
        every = rolled(recent, []).where(F.col("points") > 0).select(F.lit("*").alias("dataset"), "points", "first_value", "last_value", "average_value")
        out = out.unionByName(every)
    return out.select(
        "*", (F.col("last_value") - F.col("first_value")).alias("change"),
        trend_label(F.col("first_value"), F.col("last_value"), F.col("points"), higher_is_better).alias("trend"),
    )


def dataset_summary(history: DataFrame) -> DataFrame:
    """Latest record, average score, extremes, totals and trend of every dataset."""
    n = F.count(F.lit(1))
    first, last = F.min_by("quality_score", "ts"), F.max_by("quality_score", "ts")
    return history.groupBy("dataset").agg(
        F.max("ts").alias("latest_ts"), last.alias("latest_score"), F.max_by("total_issues", "ts").alias("latest_issues"),
        F.max_by("total_records", "ts").alias("latest_records"), F.avg("quality_score").alias("average_score"),
        F.max("total_issues").alias("max_issues"), F.min("total_issues").alias("min_issues"),
        F.sum("total_records").alias("total_records"), trend_label(first, last, n).alias("trend"),
    )


def apply_retention(df: DataFrame, as_of: str, days: int = 30, hours: int = 0) -> DataFrame:
    """Records not older than the period."""
    return df.where(F.col("ts") >= _ts(as_of) - F.expr(f"INTERVAL {int(days) * 24 + int(hours)} HOURS"))


def active_alerts(
    alerts: DataFrame, dataset: str | None = None, severity: str | None = None, acknowledged: DataFrame | None = None
) -> DataFrame:
    """Open alerts, filtered; acknowledged ones (alert_id) are left out."""
    out = alerts
    if dataset is not None:
        out = out.where(F.col("dataset") == dataset)
    if severity is not None:
        out = out.where(F.col("severity") == severity)
    if acknowledged is not None:
        out = out.join(acknowledged.select("alert_id"), "alert_id", "left_anti")
    return out


def clear_alerts(alerts: DataFrame, dataset: str | None = None) -> DataFrame:
    """What is left after clearing one dataset's alerts, or all."""
    return alerts.limit(0) if dataset is None else alerts.where(~F.col("dataset").eqNullSafe(dataset))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Counts in all, by severity and by dataset, with the newest alert of each group."""
    groups = F.array(
        F.struct(F.lit("all").alias("grouping"), F.lit("*").alias("value")),
        F.struct(F.lit("severity").alias("grouping"), F.col("severity").alias("value")),
        F.struct(F.lit("dataset").alias("grouping"), F.col("dataset").alias("value")),
    )
    return alerts.select("alert_id", "ts", F.inline(groups)).groupBy("grouping", "value").agg(
        F.count(F.lit(1)).alias("alerts"), F.max("ts").alias("most_recent"),
        F.max_by("alert_id", F.struct("ts", "alert_id")).alias("most_recent_id"),
    )
