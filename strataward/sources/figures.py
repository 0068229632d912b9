"""Stored figures of a dataset's files: rows, bytes, least and greatest values, nulls.

Figures are kept per file and known by path, length and time. A refresh lists the dataset,
reads the files that are new or changed, and drops those that are gone, so its work follows
the change and not the dataset. Partitions and columns are summed up from the file rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.sources import fs, journal
from strataward.sources.files import partition_files
from strataward.sources.writer import write_single

SCHEMA = (
    "file string, size_bytes long, modified timestamp, partition string, value string, version int, record_count long, "
    "columns array<struct<field: string, low: string, high: string, nulls: long>>"
)
_FILE = ["file", "size_bytes", "modified"]


def _plain(path):
    """A file's path without scheme and host, which readers write in different ways."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/+", "/")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return partition_files(spark, path).select("path", _plain(F.col("path")).alias("file"), "size_bytes", "modified", "partition", "value")


def _measured(spark: SparkSession, path: str, files: DataFrame, columns: Sequence[str], since=None) -> DataFrame:
    """Figures of the given files; ``since`` is the oldest time among them and keeps older files out of the scan."""
    rows = spark.read.parquet(path) if since is None else None
    if since is not None:
        # the schema is that of a changed file, so no other is opened
        one = files.select("path").first()[0]
        schema = spark.read.option("basePath", path).parquet(one).schema
        rows = spark.read.schema(schema).parquet(path).where(F.col("_metadata.file_modification_time") >= F.lit(since))
    rows = rows.select(_plain(F.col("_metadata.file_path")).alias("file"), *columns)
    text = lambda c: c.cast("string")
    cells = [
        F.struct(F.lit(c).alias("field"), text(F.min(c)).alias("low"), text(F.max(c)).alias("high"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in columns
    ]
    made = rows.groupBy("file").agg(F.count(F.lit(1)).alias("record_count"), F.array(*cells).alias("columns"))
    return files.drop("path").join(made, "file", "left").withColumn("record_count", F.coalesce("record_count", F.lit(0)))


def _save(df: DataFrame, table: str) -> None:
    write_single(df.selectExpr(*[f.split(" ")[0] for f in SCHEMA.split(", ")[:7]], "columns"), table, ["partition", "file"], verify=False)


def create_figures(spark: SparkSession, path: str, table: str, columns: Sequence[str]) -> None:
    """Measure every file of a dataset and store the figures, in place of earlier ones."""
    journal.settle(spark, path)
    _save(_measured(spark, path, _listed(spark, path), list(columns)).withColumn("version", F.lit(0)), table)


def load_figures(spark: SparkSession, table: str) -> DataFrame:
    """One row per file; ``version`` is the refresh that measured it."""
    return spark.read.schema(SCHEMA).parquet(table)


def refresh_figures(spark: SparkSession, path: str, table: str) -> int:
    """Bring stored figures up to date; returns how many files were read.

    The columns are those of the stored figures. A file is taken as unchanged when path, length and time are
    the same.
    """
    journal.settle(spark, path)
    stored = load_figures(spark, table)
    last = stored.agg(F.max("version").alias("version"), F.first("columns", ignorenulls=True).alias("columns")).first()
    columns = [c["field"] for c in last["columns"] or []]
    listed = _listed(spark, path)
    kept = stored.join(listed.select(*_FILE), _FILE, "left_semi")
    changed = listed.join(stored.select(*_FILE), _FILE, "left_anti")
    n, since = changed.agg(F.count(F.lit(1)), F.min("modified")).first()
    if n:
        fresh = _measured(spark, path, changed, columns, since).withColumn("version", F.lit((last["version"] or 0) + 1))
        kept = kept.unionByName(fresh)
    _save(kept, table)
    return n


def delete_figures(spark: SparkSession, table: str, partitions: Sequence[str] | None = None) -> None:
    """Forget the figures of some partitions (``field=value``), or all of them; a refresh measures them again."""
    if partitions is None:
        fs.delete(spark, table)
        return
    _save(load_figures(spark, table).where(~F.col("partition").isin(list(partitions))), table)


def partition_figures(files: DataFrame) -> DataFrame:
    """Files, bytes, rows and newest version of each partition."""
    return files.groupBy("partition", "value").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("size_bytes"), F.max("modified").alias("modified"),
        F.sum("record_count").alias("record_count"), F.max("version").alias("version"),
    )


def column_figures(files: DataFrame, types: dict[str, str]) -> DataFrame:
    """``partition``, ``field``, ``low``, ``high``, ``nulls`` of each measured column; ``types`` says how values compare."""
    cells = files.select("partition", F.inline("columns"))
    out = []
    for field, kind in types.items():
        own = cells.where(F.col("field") == field).groupBy("partition", "field")
        ends = [f(F.col(c).cast(kind)).cast("string").alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
        out.append(own.agg(*ends, F.sum("nulls").alias("nulls")))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found
