"""Revisions of keyed records between two copies of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataward.functions.ordered import all_of, any_of
from strataward.sources.files import trim_history

KEYS = ("ts_code", "end_date")  # fixed value: default key of a statement
SIGNIFICANCE = 0.05


def numeric_fields(current: DataFrame, historical: DataFrame, keys: Sequence[str]) -> list[str]:
    """Numeric non-key columns both copies have."""
    return [
        f.name for f in current.schema.fields
        if f.name not in keys and isinstance(f.dataType, T.NumericType) and f.name in historical.columns
    ]


def _matched(current: DataFrame, historical: DataFrame, keys: Sequence[str], fields: Sequence[str], how: str) -> DataFrame:
    """Both copies side by side: keys, new fields, ``<field>_old`` and which side had the row."""
    new = current.select(*keys, *fields, F.lit(True).alias("_sw_new"))
    old = historical.select(*keys, *[F.col(f).alias(f"{f}_old") for f in fields], F.lit(True).alias("_sw_old"))
    return new.join(old, list(keys), how)


def _significant(new, old, limit: float):
    """Both known, different, and changed by at least the limit; from zero any change counts."""
    change = F.abs((new - old) / F.when(old != 0, old))
    return new.isNotNull() & old.isNotNull() & (new != old) & ((old == 0) | (change >= limit))


def new_records(current: DataFrame, historical: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return current.join(historical.select(*keys), list(keys), "left_anti")


def removed_records(current: DataFrame, historical: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Records only the historical copy has."""
    return historical.join(current.select(*keys), list(keys), "left_anti")


def detect_revisions(
    current: DataFrame, historical: DataFrame, keys: Sequence[str] = KEYS, significance: float = SIGNIFICANCE
) -> DataFrame:
    """One row per significantly changed field: old and new value, relative and absolute change."""
    fields = numeric_fields(current, historical, keys)
    if not fields:
        raise ValueError("no numeric field to compare")
    both = _matched(current, historical, keys, fields, "inner")
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{f}_old").cast("double").alias("old_value"),
                F.col(f).cast("double").alias("new_value"),
            )
            for f in fields
        ]
    )
    rows = both.select(*keys, F.inline(cells))
    old, new = F.col("old_value"), F.col("new_value")
    return rows.where(_significant(new, old, significance)).select(
        *keys, "field", "old_value", "new_value",
        F.when(old == 0, F.lit(float("inf"))).otherwise((new - old) / F.when(old != 0, old)).alias("change_pct"),
        F.abs(new - old).alias("abs_change"),
    )


def _unchanged(fields: Sequence[str]):
    if not fields:
        return F.lit(False)
    return all_of([F.col(f).eqNullSafe(F.col(f"{f}_old")) for f in fields])


def unchanged_records(current: DataFrame, historical: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys whose numeric fields are all equal in both copies."""
    fields = numeric_fields(current, historical, keys)
    return _matched(current, historical, keys, fields, "inner").where(_unchanged(fields)).select(*keys)


def revision_stats(
    current: DataFrame, historical: DataFrame, keys: Sequence[str] = KEYS, significance: float = SIGNIFICANCE
) -> DataFrame:
    """Counts of every class of record from one full outer join."""
    fields = numeric_fields(current, historical, keys)
    both = _matched(current, historical, keys, fields, "full_outer")
    matched = F.col("_sw_new").isNotNull() & F.col("_sw_old").isNotNull()
    revised = matched & any_of([_significant(F.col(f), F.col(f"{f}_old"), significance) for f in fields])
    n = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0))
    return both.agg(
        n(F.col("_sw_new").isNotNull()).alias("total_records"),
        n(revised).alias("revised_records"),
        n(F.col("_sw_old").isNull()).alias("new_records"),
        n(matched & _unchanged(fields)).alias("unchanged_records"),
        n(F.col("_sw_new").isNull()).alias("removed_records"),
    )


def revision_history(
    versions: DataFrame, keys: Sequence[str] = KEYS, version: Sequence[str] = ("version",), depth: int = 3
) -> DataFrame:
    """Newest versions of every key, cut per task before the shuffle."""
    return trim_history(versions, list(keys), list(version), depth)
