"""Dataset writers: partition replacement, single-folder replacement and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataward.sources import fs, journal
from strataward.sources.catalog import NONE, YEAR, YEAR_MONTH, DatasetSpec

MAX_TOUCHED = 100_000  # partition folders one write may replace
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: where Spark puts rows without a partition value


def _laid_out(df: DataFrame, by: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """Rows of a partition together, in files of the advised size, sorted inside.

    ``rebalance`` lets AQE split a partition value that holds most of the rows
    and join small ones, so a year never has to fit one task.
    """
    sort = [c for c in sort if c in df.columns and c not in by]
    df = df.hint("rebalance", *by) if by else df.hint("rebalance")
    order = [*by, *sort]
    return df.sortWithinPartitions(*order) if order else df


def _require(df: DataFrame, by: Sequence[str]) -> None:
    missing = [c for c in by if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns {missing} are missing; have {df.columns}")


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write by partition; "overwrite" replaces only the partitions in the frame."""
    by = list(by)
    _require(df, by)
    (
        _laid_out(df, by, sort)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*by)
        .parquet(path)
    )


def write_yearly(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    write_partitioned(df, path, ["year"], sort)


def write_monthly(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    write_partitioned(df, path, ["year_month"], sort)


def write_single(df: DataFrame, path: str, sort: Sequence[str] = (), verify: bool = True) -> None:
    """Replace an unpartitioned dataset; reads one row back when verifying.

    The rows go to a sibling folder, which takes the dataset's place once it is complete.
    """
    spark = df.sparkSession
    staging = fs.staging_for(path)
    _laid_out(df, [], sort).write.option("compression", "zstd").parquet(staging)
    if verify:
        spark.read.parquet(staging).limit(1).collect()
    fs.replace_folder(spark, staging, path)
    spark.catalog.refreshByPath(path)


def write_dataset(df: DataFrame, spec: DatasetSpec) -> None:
    """Write with the layout the catalog names."""
    if spec.granularity == NONE:
        write_single(df, spec.path, spec.sort_fields)
    elif spec.granularity in (YEAR, YEAR_MONTH):
        write_partitioned(df, spec.path, spec.partition_by, spec.sort_fields)
    else:
        raise ValueError(f"no writer for layout {spec.granularity}")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first) -> DataFrame:
    """One row per key. Spark limits each group before the shuffle, so copies cost little.

    Rows that the order leaves equal are told apart by a hash of their content, so a
    second run keeps the same one.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first, F.xxhash64(*df.columns))
    return df.withColumn("_sw_rank", F.row_number().over(w)).where(F.col("_sw_rank") <= 1).drop("_sw_rank")


def touched_values(df: DataFrame, by: str) -> list:
    """Partition values of a frame, null among them: a list of years or months, checked for size."""
    values = [r[0] for r in df.select(by).distinct().limit(MAX_TOUCHED + 1).collect()]
    if len(values) > MAX_TOUCHED:
        raise ValueError(f"more than {MAX_TOUCHED} partitions touched; {by} is not a partition column")
    return values


def in_partitions(by: str, values: Sequence) -> Column:
    """Rows of the given partitions; None stands for the partition of rows without a value. Prunes folders."""
    known = [v for v in values if v is not None]
    here = F.col(by).isin(known) if known else F.lit(False)
    return here | F.col(by).isNull() if any(v is None for v in values) else here


def stage_partitions(df: DataFrame, path: str, by: str, sort: Sequence[str] = (), lay_out: bool = True) -> str:
    """Write partitions to a sibling folder of the dataset; returns it."""
    staging = fs.staging_for(path)
    out = _laid_out(df, [by], sort) if lay_out else df
    out.write.option("compression", "zstd").partitionBy(by).parquet(staging)
    return staging


def rewrite_partitions(
    spark: SparkSession, df: DataFrame, path: str, by: str, sort: Sequence[str] = (), lay_out: bool = True
) -> list[str]:
    """Replace partitions with rows that were read from them.

    The rows go to a sibling folder first. All folders are one commit: after a crash the dataset is as it
    was, or, once the commit is decided, the next call or ``read_dataset`` carries it through.
    """
    record = journal.commit_folders(spark, path, stage_partitions(df, path, by, sort, lay_out))
    journal.finish(spark, path, record)
    return list(record.folders)


def merged_rows(df: DataFrame, path: str, by: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The touched partitions after an upsert: stored and incoming rows, the latest of each key.

    Latest is by ``order`` columns, then incoming over stored. Only touched partitions are read; rows
    whose partition value is null are a partition like any other.
    """
    spark = df.sparkSession
    _require(df, [by, *keys, *order])
    newest = [F.col(c).desc_nulls_last() for c in order]
    if not fs.has_parquet(spark, path):
        return latest_per_key(df, [by, *keys], newest)
    incoming = df.withColumn("_sw_new", F.lit(1))
    stored = spark.read.parquet(path)
    stored = stored.where(in_partitions(by, touched_values(df, by))).withColumn("_sw_new", F.lit(0))
    both = stored.unionByName(incoming, allowMissingColumns=True)
    return latest_per_key(both, [by, *keys], [*newest, F.col("_sw_new").desc()]).drop("_sw_new")


def upsert_partitioned(
    df: DataFrame,
    path: str,
    by: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    sort: Sequence[str] = (),
) -> None:
    """Merge rows into their partitions: latest row per key wins, others stay.

    Keys must imply the partition. Only touched partitions are read and rewritten, as one commit.
    """
    spark = df.sparkSession
    journal.settle(spark, path)
    rewrite_partitions(spark, merged_rows(df, path, by, keys, order), path, by, sort)
