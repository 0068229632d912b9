"""Integrity across datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.functions.dates import OLDEST_DATE, as_date
from strataward.operators.consistency import date_bound_rules, date_fields
from strataward.operators.issues import CountRules, issue_columns, no_issues, union_issues

# fixed values: words that mark a financial dataset
FINANCIAL_WORDS = ("balance", "income", "cash", "financial")


def common_columns(datasets: dict[str, DataFrame]) -> list[str]:
    """Columns every dataset has, in the order of the first."""
    frames = list(datasets.values())
    if not frames:
        return []
    return [c for c in frames[0].columns if all(c in f.columns for f in frames[1:])]


def _spark(datasets):
    return next(iter(datasets.values())).sparkSession


def check_code_consistency(datasets: dict[str, DataFrame], code_col: str = "ts_code") -> DataFrame:
    """Codes of any dataset that another one lacks; one issue per code and dataset.

    One shuffle by code: each task first reduces its rows to the datasets seen.
    """
    if len(datasets) < 2 or code_col not in common_columns(datasets):
        return no_issues(_spark(datasets))
    names = sorted(datasets)
    seen = None
    for name in names:
        one = datasets[name].select(F.col(code_col).cast("string").alias("code"), F.lit(name).alias("ds"))
        seen = one if seen is None else seen.unionByName(one)
    per_code = seen.where(F.col("code").isNotNull()).groupBy("code").agg(F.collect_set("ds").alias("have"))
    lacking = F.array_except(F.array(*[F.lit(n) for n in names]), F.col("have"))
    rows = per_code.where(F.size("have") < len(names)).select("code", F.explode(lacking).alias("ds"))
    said = F.concat(F.lit("Code "), "code", F.lit(" is missing in dataset "), "ds")
    return rows.select(*issue_columns(F.col("ds"), "cross", "missing_stock_code", code_col, F.col("code"), description=said))


def date_ranges(datasets: dict[str, DataFrame], date_col: str) -> DataFrame:
    """First and last day of each dataset; one row each."""
    out = None
    for name in sorted(datasets):
        df = datasets[name]
        day = as_date(df, date_col)
        one = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(F.lit(name).alias("ds"), "lo", "hi")
        out = one if out is None else out.unionByName(one)
    return out.where(F.col("lo").isNotNull())


def check_date_alignment(datasets: dict[str, DataFrame], date_col: str) -> DataFrame:
    """Ordered pairs of datasets whose date ranges are disjoint.

    The ranges fit one small array (one entry per dataset), so pairs come from it.
    """
    ranges = date_ranges(datasets, date_col).agg(F.collect_list(F.struct("ds", "lo", "hi")).alias("r"))
    a = ranges.select("r", F.explode("r").alias("a"))
    apart = F.filter(
        "r",
        lambda b: (b["ds"] != F.col("a.ds"))
        & (F.greatest(F.col("a.lo"), b["lo"]) > F.least(F.col("a.hi"), b["hi"])),
    )
    pairs = a.select("a", F.explode(apart).alias("b"))
    span = lambda x: F.concat(x["ds"], F.lit(" ("), x["lo"].cast("string"), F.lit(" to "), x["hi"].cast("string"), F.lit(")"))
    said = F.concat(F.lit("No overlap between "), span(F.col("a")), F.lit(" and "), span(F.col("b")))
    return pairs.select(
        *issue_columns(F.col("a.ds"), "cross", "date_range_no_overlap", date_col, F.col("b.ds"), description=said)
    )


def check_duplicate_entries(
    df: DataFrame, dataset: str, keys: Sequence[str] = ("ts_code", "end_date")
) -> DataFrame:
    """Keys with more than one row; counts combine before the shuffle."""
    code, period = keys
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    said = F.concat(
        F.lit("Duplicate entries for "), F.coalesce(F.col(code).cast("string"), F.lit("null")), F.lit(" on "),
        F.coalesce(F.col(period).cast("string"), F.lit("null")), F.lit(": "), F.col("n").cast("string"),
    )
    return many.select(
        *issue_columns(dataset, "cross", "duplicate_financial_entry", period, F.col(code), F.col(period), F.col("n"), said)
    )


def financial_datasets(datasets: dict[str, DataFrame]) -> list[str]:
    return [n for n in datasets if any(w in n.lower() for w in FINANCIAL_WORDS)]


def check_temporal(df: DataFrame, dataset: str, as_of: str, oldest: str = OLDEST_DATE) -> DataFrame:
    """Future and very old values in every date column, in one aggregate."""
    rules = CountRules(dataset)
    date_bound_rules(rules, df, as_of, oldest, fields=date_fields(df), scope="cross")
    return rules.issues(df)


def check_references(
    main: DataFrame, reference: DataFrame, dataset: str, key: str = "ts_code", ref_key: str | None = None
) -> DataFrame:
    """Keys of the main dataset that the reference lacks; one issue per key."""
    ref_key = ref_key or key
    for df, c in ((main, key), (reference, ref_key)):
        if c not in df.columns:
            raise ValueError(f"column {c} is missing; have {df.columns}")
    rows = main.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = rows.join(reference.select(F.col(ref_key).alias(key)), key, "left_anti")
    said = F.concat(F.lit("Key "), F.col(key).cast("string"), F.lit(" has no reference"))
    return lost.select(*issue_columns(dataset, "referential", "invalid_reference", key, F.col(key), count=F.col("n"), description=said))


def reference_counts(main: DataFrame, reference: DataFrame, key: str = "ts_code", ref_key: str | None = None) -> DataFrame:
    """Distinct keys on both sides and how many are missing, in one pass by key."""
    ref_key = ref_key or key
    both = main.select(F.col(key).alias("k"), F.lit(1).alias("m"), F.lit(0).alias("r")).unionByName(
        reference.select(F.col(ref_key).alias("k"), F.lit(0).alias("m"), F.lit(1).alias("r"))
    )
    per = both.where(F.col("k").isNotNull()).groupBy("k").agg(F.max("m").alias("m"), F.max("r").alias("r"))
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return per.agg(
        total(F.col("m")).alias("main_keys"),
        total(F.col("r")).alias("reference_keys"),
        total((F.col("m") == 1) & (F.col("r") == 0)).alias("missing_keys"),
    ).withColumn("valid", F.col("missing_keys") == 0)


def validate_cross_dataset(
    datasets: dict[str, DataFrame], as_of: str, code_col: str = "ts_code", oldest: str = OLDEST_DATE
) -> DataFrame:
    """All cross-dataset checks as issue rows."""
    spark = _spark(datasets)
    common = common_columns(datasets)
    frames = []
    if len(datasets) > 1 and code_col in common:
        frames.append(check_code_consistency(datasets, code_col))
    dated = [c for c in common if "date" in c.lower()]
    if len(datasets) > 1:
        frames += [check_date_alignment(datasets, c) for c in dated]
    for name in financial_datasets(datasets):
        if {code_col, "end_date"} <= set(datasets[name].columns):
            frames.append(check_duplicate_entries(datasets[name], name, (code_col, "end_date")))
    for name, df in datasets.items():
        if date_fields(df):
            frames.append(check_temporal(df, name, as_of, oldest))
    return union_issues(spark, frames)
