"""Compaction, recompression, retention and rebuild of partitioned datasets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataward.functions.ordered import BUCKET, split_along
from strataward.functions.size import BROADCAST_KEYS, KEY
from strataward.session import stored_frame
from strataward.sources import fs, journal
from strataward.sources.catalog import NONE, DatasetSpec
from strataward.sources.files import partition_files, partition_sizes, storage_efficiency
from strataward.sources.writer import MAX_TOUCHED, in_partitions, rewrite_partitions, write_dataset

MB = 1024 * 1024
TASK_MB = 128.0  # files that one task of a compaction writes, together


def _folders(sizes: DataFrame) -> list:
    """Partition rows on the driver: one per folder, checked for count."""
    rows = sizes.limit(MAX_TOUCHED + 1).collect()
    if len(rows) > MAX_TOUCHED:
        raise ValueError(f"more than {MAX_TOUCHED} partitions")
    return sorted(rows, key=lambda r: r["partition"])


def _stored(spark: SparkSession, path: str, by: str, values: Sequence[str | None]) -> DataFrame:
    """Rows of some partitions, by their text values; the filter prunes folders."""
    stored = spark.read.parquet(path)
    typed = [None if v is None else F.lit(v).cast(stored.schema[by].dataType) for v in values]
    return stored.where(in_partitions(by, typed))


def compact_small(
    spark: SparkSession, path: str, by: str, sort: Sequence[str] = (), threshold_mb: float = 10.0, max_partitions: int | None = None
) -> list[str]:
    """Join the files of partitions whose files are small, inside their own folder.

    Rows keep their partition key, so later scans still prune. Returns the folders
    rewritten; a folder needs at least two files to be worth it.
    """
    journal.settle(spark, path)
    sizes = partition_sizes(partition_files(spark, path)).where(
        (F.col("file_count") >= 2) & (F.col("size_bytes") / F.col("file_count") < threshold_mb * MB)
    )
    values = [r["value"] for r in _folders(sizes)][:max_partitions]
    if not values:
        return []
    return rewrite_partitions(spark, _stored(spark, path, by, values), path, by, sort)


def _first_tasks(sizes: DataFrame, together: int) -> DataFrame:
    """``KEY``, ``_sw_first`` and ``_sw_most``: the first task of each partition, and the number of tasks it shares.

    ``together`` partitions, those with the most files first, share tasks: file i of each goes to the i-th of them.
    """
    rank = F.row_number().over(Window.orderBy(F.col("_sw_nb").desc(), KEY)) - 1
    grouped = sizes.select(KEY, "_sw_nb", F.floor(rank / together).alias("_sw_group"))
    most = grouped.groupBy("_sw_group").agg(F.max("_sw_nb").alias("_sw_most"))
    earlier = Window.orderBy("_sw_group").rowsBetween(Window.unboundedPreceding, -1)
    first = most.select("*", F.coalesce(F.sum("_sw_most").over(earlier), F.lit(0)).alias("_sw_first"))
    return grouped.join(first, "_sw_group").select(KEY, "_sw_first", "_sw_most")


def compact_to_target(
    spark: SparkSession, path: str, by: str, sort: Sequence[str] = (), target_mb: float = 100.0
) -> list[str]:
    """Rewrite each partition as max(1, floor(bytes / target)) files that follow each other along ``sort``.

    Small partitions are joined to one file and large ones split. Cut points come from a sample per
    partition, so the files of a partition are even and their key ranges do not overlap. Equal keys are told
    apart by a hash of the row, so that a key with most of the rows is split too; files then
    share that key. A task writes one file, or, where the target is small, one file of each of several
    partitions, up to 128 MB in all. A partition that has its number of files already is left alone.
    """
    journal.settle(spark, path)
    wanted = F.greatest(F.floor(F.col("size_bytes") / (target_mb * MB)), F.lit(1)).cast("long")
    plan = partition_sizes(partition_files(spark, path)).withColumn("files", wanted).where("files <> file_count")
    plan = stored_frame(plan.select("partition", "value", "files"), "file_plan")
    folders = _folders(plan)
    if not folders:
        return []
    stored = spark.read.parquet(path)
    kind = stored.schema[by].dataType
    rows = _stored(spark, path, by, [r["value"] for r in folders])
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_sw_n"))  # from file footers
    files = plan.select(F.col("value").cast(kind).alias("_sw_value"), F.col("files").alias("_sw_nb"))
    sizes = counts.join(files, F.col(by).eqNullSafe(F.col("_sw_value"))).select(F.struct(by).alias(KEY), "_sw_n", "_sw_nb")
    order = [c for c in sort if c in rows.columns and c != by]
    keyed = rows.withColumns({KEY: F.struct(by), "_sw_tie": F.xxhash64(*rows.columns)})
    cut = split_along(keyed, [*order, "_sw_tie"], stored_frame(sizes, "file_sizes"), len(folders))
    # buckets get numbers without holes: each is one file
    slots = cut.select(KEY, BUCKET).distinct().withColumn("_sw_slot", F.row_number().over(Window.partitionBy(KEY).orderBy(BUCKET)) - 1)
    firsts = stored_frame(_first_tasks(sizes, max(1, int(TASK_MB / target_mb))), "first_tasks")
    numbered = slots.join(F.broadcast(firsts), KEY).select(KEY, BUCKET, (F.col("_sw_first") + F.col("_sw_slot")).cast("int").alias("_sw_slot"))
    total = plan.agg(F.sum("files")).first()[0]
    tasks = firsts.agg(F.max(F.col("_sw_first") + F.col("_sw_most"))).first()[0]
    numbered = F.broadcast(numbered) if total <= BROADCAST_KEYS else numbered
    spread = cut.join(numbered, [KEY, BUCKET]).select(*rows.columns, "_sw_slot").repartitionById(int(tasks), F.col("_sw_slot"))
    return rewrite_partitions(spark, spread.sortWithinPartitions(by, *order).drop("_sw_slot"), path, by, sort, lay_out=False)


def recompress(
    spark: SparkSession, path: str, by: str, sort: Sequence[str] = (), large_mb: float = 50.0
) -> list[str]:
    """Rewrite every large partition with zstd."""
    journal.settle(spark, path)
    sizes = partition_sizes(partition_files(spark, path)).where(F.col("size_bytes") > large_mb * MB)
    values = [r["value"] for r in _folders(sizes)]
    return rewrite_partitions(spark, _stored(spark, path, by, values), path, by, sort) if values else []


def optimize_layout(
    spark: SparkSession, path: str, by: str, strategy: str = "auto", sort: Sequence[str] = (), **options
) -> dict[str, list[str]]:
    """Run compaction steps by name: merge, compress, repartition, or auto for all that apply."""
    steps: dict[str, Callable] = {"merge": compact_small, "compress": recompress, "repartition": compact_to_target}
    if strategy == "auto":
        names = ["merge", "compress"]
        score = storage_efficiency(partition_sizes(partition_files(spark, path))).first()["score"]
        if score < 60:
            names.append("repartition")
    elif strategy in steps:
        names = [strategy]
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return {n: steps[n](spark, path, by, sort, **options.get(n, {})) for n in names}


def expired_partitions(stats: DataFrame, as_of: str, days: int) -> DataFrame:
    """Partitions whose newest file is older than the cutoff."""
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    return stats.where(F.col("modified") < cutoff)


def archive_partitions(
    spark: SparkSession, path: str, expired: DataFrame, action: str, dest: str | None = None
) -> int:
    """Drop, move or copy partitions; returns how many."""
    if action not in ("cleanup", "archive", "backup"):
        raise ValueError(f"unknown action {action}")
    if action != "cleanup" and dest is None:
        raise ValueError(f"{action} needs a destination")
    rows = [r for r in _folders(expired) if r["partition"]]
    if action == "backup" and rows:
        by = rows[0]["partition"].split("=", 1)[0]
        kept = _stored(spark, path, by, [r["value"] for r in rows])
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(dest)
    for r in rows:
        folder = f"{path}/{r['partition']}"
        if action == "cleanup":
            fs.delete(spark, folder)
        elif action == "archive":
            fs.move(spark, folder, f"{dest}/{r['partition']}")
    spark.catalog.refreshByPath(path)
    return len(rows)


def rebuild_dataset(
    spark: SparkSession, source: DataFrame, spec: DatasetSpec, prepare: Callable[[DataFrame, DatasetSpec], DataFrame]
) -> None:
    """Write a partitioned dataset anew from source rows; no unpartitioned fallback."""
    if spec.granularity == NONE:
        raise ValueError(f"{spec.name} is not partitioned")
    write_dataset(prepare(source, spec), spec)
