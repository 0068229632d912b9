"""Quality scores, severities and reports over the issues table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: words in a check name per severity, tested in this order
SEVERITY_WORDS = (
    ("critical", "missing|null|required|invalid"),
    ("high", "anomaly|inconsistency|revision"),
    ("medium", "bounds|range|format"),
)
SEVERITIES = ("critical", "high", "medium", "low")


def quality_score(issues: Column, records: Column) -> Column:
    """1 less issues per record, within [0, 1]; without records 1 or 0."""
    empty = F.when(issues == 0, 1.0).otherwise(0.0)
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.try_divide(issues, records)))
    return F.when(records > 0, share).otherwise(empty)


def issue_severity(check: Column | str) -> Column:
    low = F.lower(F.col(check) if isinstance(check, str) else check)
    out = None
    for name, words in SEVERITY_WORDS:
        out = F.when(low.rlike(words), name) if out is None else out.when(low.rlike(words), name)
    return out.otherwise("low")


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues per dataset, in all and by severity, with the kinds of check that found them."""
    tagged = issues.withColumn("severity", issue_severity("check"))
    return tagged.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total_issues"),
        *[F.count_if(F.col("severity") == s).alias(f"{s}_issues") for s in SEVERITIES],
        F.array_join(F.array_sort(F.collect_set("scope")), ",").alias("validation_types"),
    )


def dataset_scores(issues: DataFrame, totals: DataFrame) -> DataFrame:
    """Score per dataset. ``totals``: dataset, total_records."""
    counts = issues.groupBy("dataset").agg(F.count(F.lit(1)).alias("total_issues"))
    both = totals.join(counts, "dataset", "left").withColumn("total_issues", F.coalesce("total_issues", F.lit(0)))
    return both.select(
        "dataset", "total_records", "total_issues",
        quality_score(F.col("total_issues"), F.col("total_records")).alias("quality_score"),
    )


def report_rows(issues: DataFrame, totals: DataFrame, generated_at: str) -> DataFrame:
    """One JSON document per dataset: metadata, score and summary."""
    joined = dataset_scores(issues, totals).join(issue_summary(issues).drop("total_issues"), "dataset", "left")
    zeros = {f"{s}_issues": F.coalesce(f"{s}_issues", F.lit(0)) for s in SEVERITIES}
    joined = joined.withColumns(zeros)
    document = F.to_json(
        F.struct(
            F.lit(generated_at).alias("generated_at"), "dataset", "total_records", "total_issues",
            F.round("quality_score", 6).alias("quality_score"), *[f"{s}_issues" for s in SEVERITIES],
        )
    )
    return joined.select("dataset", document.alias("report"))


def write_report(issues: DataFrame, totals: DataFrame, generated_at: str, path: str) -> None:
    """Summary documents and the detailed issues as JSON lines."""
    report_rows(issues, totals, generated_at).select("report").write.mode("overwrite").text(f"{path}/summary")
    issues.withColumn("severity", issue_severity("check")).write.mode("overwrite").json(f"{path}/issues")
