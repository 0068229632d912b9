"""The write path: source to stored dataset, and the incremental path around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.operators.coverage import coverage, find_gaps
from strataward.operators.dictionary import build_dimensions, encode
from strataward.operators.normalize import normalize
from strataward.operators.planning import due_rows, plan_loads
from strataward.operators.consistency import date_fields
from strataward.plans.flow import validate_dataset
from strataward.session import stored_frame
from strataward.sources.catalog import CATALOG, NONE, DatasetSpec, due_datasets
from strataward.sources.reader import source_frame
from strataward.sources.writer import upsert_partitioned, write_dataset


def prepare(df: DataFrame, spec: DatasetSpec, dictionary: DataFrame | None = None) -> DataFrame:
    """Normalised and encoded rows, still lazy."""
    out = normalize(df, spec)
    if dictionary is not None and "ts_code" in out.columns:
        out = encode(out, dictionary, "ts_code")
    return out


def run_load(
    spark: SparkSession,
    spec: DatasetSpec,
    source: DataFrame | str,
    dictionary: DataFrame | None = None,
    mode: str = "upsert",
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    validate_as_of: str | None = None,
    data_type: str = "stock",
) -> DataFrame | None:
    """Load one source into its dataset; returns the issues when validation is asked for.

    mode "upsert" merges by key into the touched partitions (of equal keys the newest by
    ``order`` stays), "overwrite" replaces them. Issues are found before the write, within
    each key, and stored, so they don't change with the dataset.
    """
    rows = prepare(source_frame(spark, source), spec, dictionary)
    issues = None
    if validate_as_of is not None:
        dated = date_fields(rows)
        series = [k for k in keys if k not in dated]
        steps = [*[k for k in keys if k in dated], *order]
        issues = stored_frame(validate_dataset(rows, spec.name, data_type, validate_as_of, steps, series), "issues")
    if mode == "overwrite" or spec.granularity == NONE:
        write_dataset(rows, spec)
    elif mode == "upsert":
        if not keys:
            raise ValueError("upsert needs keys")
        upsert_partitioned(rows, spec.path, spec.partition_by[0], keys, order, spec.sort_fields)
    else:
        raise ValueError(f"unknown mode {mode}")
    return issues


def plan_and_load(
    spark: SparkSession,
    spec: DatasetSpec,
    source: DataFrame,
    universe: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str],
    dictionary: DataFrame | None = None,
    gap_policy: str = "full",
    calendar: DataFrame | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Scan coverage, decide per code, load what is due from a staged source; returns the plan.

    ``source`` has ``ts_code`` and the dataset's date field. The plan is stored before the
    load replaces the files it was made from. Of equal keys the newest by ``order`` stays.
    """
    stored = spark.read.parquet(spec.path)
    field = spec.partition_field
    cov = coverage(stored, spec.name, "ts_code", field, calendar)
    gaps = find_gaps(stored, spec.name, "ts_code", field, calendar) if gap_policy == "missing" else None
    plan = stored_frame(plan_loads(cov, universe, spec.name, start, end, gap_policy, gaps), "plan")
    dated = normalize(source, spec).withColumn("_day", F.to_date(F.col(f"{field}_int").cast("string"), "yyyyMMdd"))
    rows = due_rows(plan, dated, "ts_code", "_day").drop("_day")
    if dictionary is not None:
        rows = encode(rows, dictionary, "ts_code")
    upsert_partitioned(rows, spec.path, spec.partition_by[0], keys, order, spec.sort_fields)
    return plan


def refresh_due(
    entities: DataFrame, existing: dict[str, DataFrame], day_of_week: int, day_of_month: int
) -> tuple[dict[str, DataFrame], list[DatasetSpec]]:
    """Dimensions brought up to date and the datasets due on a day."""
    return build_dimensions(entities, existing), [CATALOG[n] for n in due_datasets(day_of_week, day_of_month)]
