"""Validation of one or several datasets, with revisions and a report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.functions.size import AUTO, SkewPolicy
from strataward.operators.anomaly import DEFAULTS as ANOMALY_DEFAULTS
from strataward.operators.anomaly import AnomalyConfig, anomaly_summary, detect_anomalies
from strataward.operators.consistency import DEFAULTS as CONSISTENCY_DEFAULTS
from strataward.operators.consistency import ConsistencyConfig, validate_consistency
from strataward.operators.cross import validate_cross_dataset
from strataward.operators.issues import issue_columns, union_issues
from strataward.operators.revision import revision_stats
from strataward.operators.score import dataset_scores, issue_summary, report_rows
from strataward.session import stored_frame

PRICED = ("stock", "index")  # fixed values: types that get anomaly checks


@dataclass(frozen=True)
class FlowConfig:
    anomaly: AnomalyConfig = ANOMALY_DEFAULTS
    consistency: ConsistencyConfig = CONSISTENCY_DEFAULTS
    policy: SkewPolicy = AUTO


@dataclass
class FlowResult:
    issues: DataFrame
    totals: DataFrame
    scores: DataFrame
    summary: DataFrame
    report: DataFrame
    revisions: DataFrame | None = None


def anomaly_issues(
    df: DataFrame, dataset: str, order_by: Sequence[str], keys: Sequence[str], config: FlowConfig = FlowConfig()
) -> DataFrame:
    """One issue row with the number of anomalous closes, if any.

    Rows that ``order_by`` leaves equal follow by close and volume, so the number is one and the same in every run.
    """
    volume = "volume" if "volume" in df.columns else None
    order = list(dict.fromkeys([*order_by, "close", *([volume] if volume else [])]))
    narrow = df.select(*dict.fromkeys([*keys, *order]))
    found = anomaly_summary(detect_anomalies(narrow, "close", order, keys, volume, config.anomaly, config.policy))
    said = F.concat(F.col("anomaly_count").cast("string"), F.lit(" anomalous values of close"))
    return found.where(F.col("anomaly_count") > 0).select(
        *issue_columns(dataset, "anomaly", "price_anomaly", "close", count=F.col("anomaly_count"), description=said)
    )


def validate_dataset(
    df: DataFrame, dataset: str, data_type: str, as_of: str, order_by: Sequence[str] = (), keys: Sequence[str] = (),
    config: FlowConfig = FlowConfig(),
) -> DataFrame:
    """Consistency issues, and anomalies for priced types."""
    frames = [validate_consistency(df, dataset, data_type, as_of, order_by, keys, config.consistency, config.policy)]
    if data_type in PRICED and "close" in df.columns and order_by:
        frames.append(anomaly_issues(df, dataset, order_by, keys, config))
    return union_issues(df.sparkSession, frames)


def validate_datasets(
    datasets: dict[str, DataFrame], types: dict[str, str], as_of: str,
    order_by: dict[str, Sequence[str]] | None = None, keys: Sequence[str] = (), config: FlowConfig = FlowConfig(),
) -> DataFrame:
    """Every dataset on its own, then all of them together."""
    order_by = order_by or {}
    frames = [
        validate_dataset(df, name, types.get(name, "other"), as_of, order_by.get(name, ()), keys, config)
        for name, df in datasets.items()
    ]
    frames.append(validate_cross_dataset(datasets, as_of))
    return union_issues(frames[0].sparkSession, frames)


def record_totals(datasets: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in datasets.items():
        one = df.agg(F.count(F.lit(1)).alias("total_records")).select(F.lit(name).alias("dataset"), "total_records")
        out = one if out is None else out.unionByName(one)
    return out


def quality_flow(
    datasets: dict[str, DataFrame], types: dict[str, str], as_of: str,
    order_by: dict[str, Sequence[str]] | None = None, keys: Sequence[str] = (),
    historical: DataFrame | None = None, revision_keys: Sequence[str] = ("ts_code", "end_date"),
    config: FlowConfig = FlowConfig(),
) -> FlowResult:
    """Validate, compare with history when one dataset and its history are given, score and report.

    Issues and totals are computed once and stored; scores, summary and report read these few rows.
    """
    issues = stored_frame(validate_datasets(datasets, types, as_of, order_by, keys, config), "issues")
    totals = stored_frame(record_totals(datasets), "totals")
    revisions = None
    if historical is not None and len(datasets) == 1:
        revisions = revision_stats(next(iter(datasets.values())), historical, revision_keys)
    return FlowResult(
        issues, totals, dataset_scores(issues, totals), issue_summary(issues), report_rows(issues, totals, as_of), revisions
    )
