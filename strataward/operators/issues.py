"""The flat issues table all checks return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.functions.size import empty_frame

COLUMNS = ("dataset", "scope", "check", "field", "entity", "period", "count", "description")
SCHEMA = ", ".join(f"{c} {'long' if c == 'count' else 'string'}" for c in COLUMNS)


def no_issues(spark: SparkSession) -> DataFrame:
    return empty_frame(spark, SCHEMA)


def text(value) -> Column:
    return F.lit(value).cast("string") if not isinstance(value, Column) else value.cast("string")


def issue_columns(dataset, scope, check, field=None, entity=None, period=None, count=1, description="") -> list[Column]:
    """Columns of one issue row, literal or computed."""
    values = {
        "dataset": text(dataset), "scope": text(scope), "check": text(check), "field": text(field),
        "entity": text(entity), "period": text(period), "description": text(description),
        "count": (count if isinstance(count, Column) else F.lit(count)).cast("long"),
    }
    return [values[c].alias(c) for c in COLUMNS]


def union_issues(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df)
    return no_issues(spark) if out is None else out


class CountRules:
    """Counting rules over one frame, evaluated together in a single aggregate."""

    def __init__(self, dataset: str):
        self.dataset = dataset
        self._rules: list[tuple[str, str, str, Column, str]] = []

    def add(self, scope: str, check: str, field: str, condition: Column, said: str) -> None:
        """``said`` describes the issue with {n} for the count."""
        self._rules.append((scope, check, field, condition, said))

    def __bool__(self) -> bool:
        return bool(self._rules)

    def issues(self, df: DataFrame) -> DataFrame:
        """Rows for rules with a count above zero."""
        if not self._rules:
            return no_issues(df.sparkSession)
        counts = df.agg(
            *[
                F.coalesce(F.sum(F.coalesce(cond, F.lit(False)).cast("long")), F.lit(0)).alias(f"c{i}")
                for i, (_, _, _, cond, _) in enumerate(self._rules)
            ]
        )
        rows = []
        for i, (scope, check, field, _, said) in enumerate(self._rules):
            head, _, tail = said.partition("{n}")
            words = F.concat(F.lit(head), F.col(f"c{i}").cast("string"), F.lit(tail))
            rows.append(F.struct(*issue_columns(self.dataset, scope, check, field, count=F.col(f"c{i}"), description=words)))
        return counts.select(F.inline(F.array(*rows))).where(F.col("count") > 0)
