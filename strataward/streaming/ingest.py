"""Incremental ingest: new files to partitions, IDs and watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataward.functions.dates import as_date
from strataward.operators.watermark import load_watermarks, merge_watermarks, save_watermarks
from strataward.plans.load import prepare
from strataward.session import stored_frame
from strataward.sources import journal
from strataward.sources.catalog import NONE, DatasetSpec
from strataward.sources.fs import has_parquet
from strataward.sources.writer import in_partitions, merged_rows, stage_partitions, touched_values


def _watermark_after(rows: DataFrame, merged: DataFrame, spec: DatasetSpec, watermarks: str) -> dict:
    """Where the dataset's watermark stands once the merged partitions are in: absolute figures.

    The count moves by the change in rows of the touched partitions, which file footers tell; the rest of the
    dataset is only read where it has no watermark yet.
    """
    spark = rows.sparkSession
    by = spec.partition_by[0]
    old = load_watermarks(spark, watermarks).where(F.col("dataset") == spec.name).select("last_update_date", "record_count").first()
    newest = [rows.agg(F.max(as_date(rows, spec.partition_field))).first()[0]]
    count = merged.count()
    if has_parquet(spark, spec.path):
        stored = spark.read.parquet(spec.path)
        here = in_partitions(by, touched_values(rows, by))
        if old:
            count += (old["record_count"] or 0) - stored.where(here).count()
        else:
            count += stored.count() - stored.where(here).count()
            newest.append(stored.agg(F.max(as_date(stored, spec.partition_field))).first()[0])
    newest.append(old["last_update_date"] if old else None)
    last = max((d for d in newest if d is not None), default=None)
    return {"watermarks": watermarks, "dataset": spec.name, "last_update_date": None if last is None else last.isoformat(), "record_count": count}


def _save_after(spark: SparkSession, after: dict) -> None:
    schema = "dataset string, last_update_date date, record_count long, updated_at timestamp_ntz"
    last = F.lit(after["last_update_date"]).cast("date")
    mark = spark.range(1).select(
        F.lit(after["dataset"]).alias("dataset"), last.alias("last_update_date"), F.lit(after["record_count"]).cast("long").alias("record_count"),
        last.cast("timestamp_ntz").alias("updated_at"),
    ).to(StructType.fromDDL(schema))
    save_watermarks(merge_watermarks(load_watermarks(spark, after["watermarks"]), mark), after["watermarks"])


def resume_commits(spark: SparkSession, path: str, watch: journal.Watch | None = None) -> None:
    """Carry through what an interrupted ingest has decided: folders first, then the watermark."""
    for record in journal.settle(spark, path):
        _save_after(spark, record.after)
        if watch:
            watch("watermark")
        journal.finish(spark, path, record)


def ingest_batch(
    batch: DataFrame, spec: DatasetSpec, dictionary: DataFrame | None, keys: Sequence[str], order: Sequence[str], watermarks: str | None,
    source: str = "", serial: int = 0, watch: journal.Watch | None = None,
) -> bool:
    """Normalise, encode, merge into partitions, then advance the watermark; all of it once or not at all.

    ``source`` and ``serial`` name the batch. The commit record with the staged folders and the watermark to be
    is stored before anything is replaced: a crash earlier leaves no trace, a crash later is
    carried through when a batch comes next. A batch that was carried through is not taken again, and
    False is returned. Without a ``source`` each call is a batch of its own. ``watch`` hears the steps.
    """
    if spec.granularity == NONE:
        raise ValueError(f"{spec.name} has no partitions to merge into")
    spark = batch.sparkSession
    resume_commits(spark, spec.path, watch)
    if source and (journal.find(spark, spec.path, journal.commit_id(source, serial))):
        return False
    if batch.isEmpty():
        return True
    rows = stored_frame(prepare(batch, spec, dictionary), "batch")
    by = spec.partition_by[0]
    staging = stage_partitions(merged_rows(rows, spec.path, by, keys, order), spec.path, by, spec.sort_fields)
    after = _watermark_after(rows, spark.read.parquet(staging), spec, watermarks) if watermarks else {}
    if watch:
        watch("staged")
    record = journal.commit_folders(spark, spec.path, staging, source, serial, after, watch)
    if after:
        _save_after(spark, after)
        if watch:
            watch("watermark")
    journal.finish(spark, spec.path, record)
    return True


def stream_ingest(
    source: DataFrame,
    spec: DatasetSpec,
    checkpoint: str,
    keys: Sequence[str],
    dictionary: DataFrame | None = None,
    order: Sequence[str] = (),
    watermarks: str | None = None,
    watch: journal.Watch | None = None,
):
    """Process all available input of a streaming frame in batches; returns the query.

    Late rows go to their own partition through the upsert. Batches are named by the checkpoint and
    their number, so one that Spark runs again after a crash counts once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, spec, dictionary, keys, order, watermarks, checkpoint, batch_id, watch)

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
