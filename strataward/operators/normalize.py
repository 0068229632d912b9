"""Field names, integer dates, partition columns and numeric text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataward.sources.catalog import NONE, YEAR, YEAR_MONTH, DatasetSpec

# fixed values: canonical name and its aliases, in priority order
ALIASES = {
    "trade_date": ("date", "tradedate"),
    "ann_date": ("announcement_date", "date", "ann_dt"),
    "ts_code": ("stock_code", "code"),
}
# fixed values: columns whose text is read as a number
NUMERIC_TEXT = ("open", "close", "high", "low", "volume", "amount")


def alias_map(columns: list[str], aliases: dict[str, tuple[str, ...]] = ALIASES) -> dict[str, str]:
    """Renames to apply: first alias present, each used once, canonical columns kept."""
    taken: set[str] = set()
    renames: dict[str, str] = {}
    for canonical, names in aliases.items():
        if canonical in columns:
            continue
        found = next((n for n in names if n in columns and n not in taken), None)
        if found:
            taken.add(found)
            renames[found] = canonical
    return renames


def rename_aliases(df: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    return df.withColumnsRenamed(alias_map(df.columns, aliases))


def date_int(c):
    """Digits of a date as an integer; null where they are not a number."""
    return F.regexp_replace(c.cast("string"), "[-/]", "").try_cast("int")


def add_date_int(df: DataFrame, field: str) -> DataFrame:
    """Add ``<field>_int``."""
    stored = df.schema[field].dataType
    c = F.col(field)
    if isinstance(stored, (T.TimestampType, T.TimestampNTZType)):
        c = c.cast("date")
    return df.withColumn(f"{field}_int", date_int(c))


def add_partition_cols(df: DataFrame, field: str, granularity: str) -> DataFrame:
    """Add ``year`` or ``year_month`` from ``<field>_int``."""
    if granularity == NONE:
        return df
    number = f"{field}_int"
    if number not in df.columns:
        if field not in df.columns:
            raise ValueError(f"partition field {field} is missing; have {df.columns}")
        df = add_date_int(df, field)
    name, divisor = {YEAR: ("year", 10000), YEAR_MONTH: ("year_month", 100)}[granularity]
    return df.withColumn(name, F.expr(f"{number} div {divisor}").cast("int"))


def coerce_numeric(df: DataFrame, columns: tuple[str, ...] = NUMERIC_TEXT) -> DataFrame:
    """Text numbers with thousands separators become doubles, null on failure."""
    text = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns(
        {c: F.replace(F.trim(F.col(c)), F.lit(","), F.lit("")).try_cast("double") for c in text}
    )


def normalize(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All field steps for one dataset; fails when a partitioned dataset lacks its field."""
    df = rename_aliases(df)
    field = spec.partition_field
    if spec.granularity != NONE and (field is None or field not in df.columns):
        raise ValueError(f"{spec.name} is partitioned by {field}, which is missing; have {df.columns}")
    if field is not None and field in df.columns:
        df = add_partition_cols(add_date_int(df, field), field, spec.granularity)
    return coerce_numeric(df)
