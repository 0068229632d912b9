"""Files and partitions of stored datasets, from listings only."""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataward.sources import fs
from strataward.sources.catalog import CATALOG, NONE, DatasetSpec
from strataward.sources.writer import NULL_FOLDER

PARTITION_RX = r"/([^/=]+)=([^/]+)/[^/]*$"


def infer_partition_field(folder: str) -> str:
    """Field name of a ``field=value`` folder; ``year`` when it has none."""
    return folder.split("=", 1)[0] if "=" in folder else "year"


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file: path, bytes, time, partition field and value (null: rows without one).

    Only path, length and time are selected, so no file content is read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length", "modificationTime")
    )
    field = F.regexp_extract("path", PARTITION_RX, 1)
    value = F.regexp_extract("path", PARTITION_RX, 2)
    return listing.select(
        "path",
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
        F.when(field != "", field).otherwise("").alias("field"),
        F.when(field != "", F.concat(field, F.lit("="), value)).otherwise("").alias("partition"),
        F.when(value != NULL_FOLDER, value).alias("value"),
    )


def partition_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("partition", "value").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size_bytes").alias("size_bytes"),
        F.min("modified").alias("created"),
        F.max("modified").alias("modified"),
    )


def storage_efficiency(sizes: DataFrame, small_mb: float = 10.0, spread_mb: float = 50.0) -> DataFrame:
    """Size spread of partitions as one row with a 0-100 score; zeros when empty."""
    mb = F.col("size_bytes") / F.lit(1024.0 * 1024.0)
    n = F.count(F.lit(1))
    spread = 100 - F.var_pop(mb) / (spread_mb * spread_mb) * 100
    score = F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), spread)))
    zero = F.lit(0.0)
    return sizes.agg(
        n.alias("partitions"),
        F.coalesce(F.sum(mb), zero).alias("total_mb"),
        F.coalesce(F.avg(mb), zero).alias("avg_mb"),
        F.coalesce(F.min(mb), zero).alias("min_mb"),
        F.coalesce(F.max(mb), zero).alias("max_mb"),
        F.coalesce(F.sum((mb < small_mb).cast("long")), F.lit(0)).alias("small_partitions"),
        F.coalesce(score, zero).alias("score"),
    )


def adjacent_small_pairs(sizes: DataFrame, small_mb: float = 5.0) -> DataFrame:
    """Partitions whose numbers differ by one and that are both small.

    A neighbour is the row with the next number, so this is an equality join.
    """
    mb = F.col("size_bytes") / F.lit(1024.0 * 1024.0)
    small = sizes.select(F.col("value").try_cast("long").alias("v"), mb.alias("mb")).where(
        F.col("v").isNotNull() & (F.col("mb") < small_mb)
    )
    after = small.select((F.col("v") - 1).alias("v"), F.col("mb").alias("next_mb"))
    return small.join(after, "v").select(
        F.col("v").alias("first_value"),
        (F.col("v") + 1).alias("second_value"),
        F.col("mb").alias("first_mb"),
        F.col("next_mb").alias("second_mb"),
    )


def layout_advice(efficiency: DataFrame) -> DataFrame:
    """Merge, split or repartition, from the efficiency row."""
    avg = F.col("avg_mb")
    action = (
        F.when(F.col("partitions") == 0, "keep")
        .when(avg < 5, "merge")
        .when(avg > 500, "split")
        .when(F.col("score") < 60, "repartition")
        .otherwise("keep")
    )
    return efficiency.withColumn("action", action)


def partition_stats(spark: SparkSession, path: str, by: str) -> DataFrame:
    """Files, bytes, times and rows of each partition.

    The row count needs no data columns, so the scan reads file footers only.
    """
    sizes = partition_sizes(partition_files(spark, path))
    rows = spark.read.parquet(path).groupBy(F.col(by).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("record_count"))
    same = sizes["value"].eqNullSafe(rows["value"])
    return sizes.join(rows, same, "left").select(
        "partition", sizes["value"], "file_count", "size_bytes", "created", "modified",
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
    )


def _plain_path(path):
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


def _read_rows(spark: SparkSession, path: str) -> DataFrame:
    """``_k`` (path), ``rows`` and ``stated`` of each file: rows read with every column, and rows by its footer; damage is passed over."""
    # the schema from all footers, in tasks: any one file may be the damaged one
    stored = spark.read.option("ignoreCorruptFiles", True).option("mergeSchema", True).parquet(path)
    file = _plain_path(F.col("_metadata.file_path")).alias("_k")
    # the hash makes the scan read every column
    read = stored.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), F.max(F.xxhash64(*stored.columns)).alias("content")).where("content IS NOT NULL")
    stated = stored.groupBy(file).agg(F.count(F.lit(1)).alias("stated"))
    return stated.join(read, "_k", "full_outer").select("_k", "rows", "stated")


def _open_error(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        errors = []
        for content in part["content"]:
            try:
                file = pq.ParquetFile(io.BytesIO(content))
                for i in range(file.num_row_groups):
                    file.read_row_group(i)
                errors.append(None)
            except Exception as e:  # whatever the damage, its text is the result
                errors.append(f"{type(e).__name__}: {e}")
        yield pd.DataFrame({"path": part["path"], "error": errors})


def damaged_files(spark: SparkSession, path: str) -> DataFrame:
    """``partition``, ``path`` and ``error`` of every file that cannot be read to its end.

    One scan of the dataset finds files that give no rows, or fewer than their footer states. Only these are
    opened again, one to a task, page by page, for the text of their error.
    """
    files = partition_files(spark, path)
    suspect = files.withColumn("_k", _plain_path(F.col("path"))).join(_read_rows(spark, path), "_k", "left")
    suspect = suspect.where("rows IS NULL OR stated IS NULL OR rows <> stated")
    paths = [r["path"] for r in suspect.select("path").collect()]  # damaged files only
    empty = [(f.rsplit("/", 2)[1] if "=" in f.rsplit("/", 2)[1] else "", f, "file of no bytes") for f in fs.empty_files(spark, path)]
    out = spark.createDataFrame(empty, "partition string, path string, error string")
    if paths:
        content = spark.read.format("binaryFile").load([_escaped(p) for p in paths]).select("path", "content").repartition(len(paths))
        opened = content.mapInPandas(_open_error, "path string, error string").where("error IS NOT NULL")
        out = out.unionByName(opened.join(files.select("path", "partition"), "path").select("partition", "path", "error"))
    return out


def _escaped(path: str) -> str:
    """A path that is no pattern."""
    return "".join("\\" + c if c in "*?[]{}" else c for c in path)


def layout_health(spark: SparkSession, path: str, small_mb: float = 10.0) -> DataFrame:
    """Rows per partition, files that gave none, and a small-file notice.

    Damaged files are skipped by the scan and show up as files without rows.
    Listings leave out files of no bytes, so those are counted per folder.
    """
    files = partition_files(spark, path)
    hollow = Counter(f.rsplit("/", 2)[1] if "=" in f.rsplit("/", 2)[1] else "" for f in fs.empty_files(spark, path))
    blank = spark.createDataFrame(sorted(hollow.items()), "partition string, empty_files long")
    joined = files.withColumn("_k", _plain_path(F.col("path"))).join(_read_rows(spark, path), "_k", "left")
    per = joined.groupBy("partition").agg(
        F.count(F.lit(1)).alias("_files"),
        F.sum("size_bytes").alias("size_bytes"),
        F.sum("rows").alias("record_count"),
        F.sum(F.col("rows").isNull().cast("long")).alias("_bad"),
        (F.avg("size_bytes") < small_mb * 1024 * 1024).alias("small_files"),
    )
    count = lambda c: F.coalesce(c, F.lit(0))
    unreadable = count("_bad") + count("empty_files")
    return per.join(blank, "partition", "full_outer").select(
        "partition",
        (count("_files") + count("empty_files")).alias("file_count"),
        count("size_bytes").alias("size_bytes"),
        count("record_count").alias("record_count"),
        unreadable.alias("unreadable_files"),
        (unreadable == 0).alias("healthy"),
        F.coalesce("small_files", F.lit(True)).alias("small_files"),
    )


def validate_layout(spark: SparkSession, root: str, catalog: dict[str, DatasetSpec] = CATALOG) -> DataFrame:
    """Expected against stored layout for every catalog dataset."""
    root = root.rstrip("/")
    rows = [F.struct(F.lit(s.name).alias("dataset"), F.lit(s.path).alias("rel"), F.lit(s.granularity).alias("expected")) for s in catalog.values()]
    specs = spark.range(1).select(F.inline(F.array(*rows)))
    relative = F.regexp_replace("path", r"^.*?" + _quoted(root) + "/", "")
    found = (
        partition_files(spark, root)
        .withColumn("rel", F.regexp_replace(relative, r"(/[^/=]+=[^/]+)*/[^/]*$", ""))
        .groupBy("rel")
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            F.bool_or(F.col("field") == "year").alias("has_year"),
            F.bool_or(F.col("field") == "year_month").alias("has_month"),
        )
    )
    actual = (
        F.when(F.col("file_count").isNull(), "missing")
        .when(F.col("has_month"), "YEAR_MONTH")
        .when(F.col("has_year"), "YEAR")
        .otherwise(NONE)
    )
    return (
        specs.join(found, "rel", "left")
        .withColumn("actual", actual)
        .select(
            "dataset", "expected", "actual", F.coalesce("file_count", F.lit(0)).alias("file_count"),
            (F.col("actual") == F.col("expected")).alias("matches"),
        )
    )


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r".^$*+?()[]{}|\\" else c for c in text)


def scan_time_summary(
    history: DataFrame, as_of: str, window_hours: int = 24, slow_ms: float = 1000.0
) -> DataFrame:
    """Average scan time per partition over the window, with the whole-window figures.

    ``history``: partition, ts, query_time_ms. Every record in the window counts;
    ``trim_history`` shortens the stored table in a step of its own.
    """
    recent = history.where(
        F.col("ts") > F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(window_hours)} HOURS")
    )
    per = recent.groupBy("partition").agg(
        F.count(F.lit(1)).alias("scans"),
        F.avg("query_time_ms").alias("avg_ms"),
        F.max("query_time_ms").alias("max_ms"),
        F.min("query_time_ms").alias("min_ms"),
        F.sum("query_time_ms").alias("total_ms"),
    )
    every = Window.partitionBy(F.lit(0))  # one row per partition folder
    return per.select(
        "*",
        (F.sum("total_ms").over(every) / F.sum("scans").over(every)).alias("overall_avg_ms"),
        F.max("max_ms").over(every).alias("overall_max_ms"),
        F.min("min_ms").over(every).alias("overall_min_ms"),
        (F.col("avg_ms") > slow_ms).alias("slow"),
    )


def scan_time_alerts(summary: DataFrame, threshold_ms: float = 1000.0) -> DataFrame:
    return summary.where(F.col("avg_ms") > threshold_ms).select(
        "partition",
        F.col("avg_ms").alias("value"),
        F.lit(float(threshold_ms)).alias("threshold"),
        F.concat(F.lit("scan of "), "partition", F.lit(" is slow")).alias("message"),
    )


def trim_history(history: DataFrame, keys: Sequence[str], newest: Sequence[str], keep: int) -> DataFrame:
    """Newest ``keep`` rows per key, cut per task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest])
    return history.withColumn("_sw_rank", F.row_number().over(w)).where(F.col("_sw_rank") <= keep).drop("_sw_rank")
