"""Dataset readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.functions.dates import iso
from strataward.sources import journal
from strataward.sources.catalog import NONE, YEAR, DatasetSpec


def read_dataset(
    spark: SparkSession, spec: DatasetSpec | str, columns: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Lazy scan of a dataset or path; columns and limit reach the scan.

    A commit that was decided but not carried through is first put in place, so no half of it is read.
    """
    path = spec if isinstance(spec, str) else spec.path
    journal.settle(spark, path)
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def source_frame(spark: SparkSession | None, source: DataFrame | str | None) -> DataFrame:
    """A frame given directly or by path."""
    if source is None:
        raise ValueError("give a DataFrame or a path")
    return spark.read.parquet(source) if isinstance(source, str) else source


def between_dates(df: DataFrame, spec: DatasetSpec, lo: str, hi: str) -> DataFrame:
    """Rows with the dataset's date in [lo, hi], with a partition predicate beside it.

    The second predicate lets the scan skip whole partitions.
    """
    lo_int, hi_int = (int(iso(x).replace("-", "")) for x in (lo, hi))
    out = df.where(F.col(f"{spec.partition_field}_int").between(lo_int, hi_int))
    if spec.granularity == NONE:
        return out
    divisor = 10000 if spec.granularity == YEAR else 100
    return out.where(F.col(spec.partition_by[0]).between(lo_int // divisor, hi_int // divisor))
