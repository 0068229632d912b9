"""Helpers that the operators share: row keys, stored intermediate tables, numbering."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataward.session import configure, scratch_path

ROW = "_row"
DOC = "_doc"
# White space of every word and text rule here: blank, and the control characters from tab to carriage return.
WHITE = r"[\x20\x09-\x0D]+"
# Rows of one Arrow batch to a Python worker: a few MB of ordinary documents.
ARROW_ROWS = 512
ARROW_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def prepare(spark: SparkSession) -> SparkSession:
    """The library's SQL settings, and small Arrow batches because rows carry whole texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage ends there, and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chosen(share: Column, *by: Column | str) -> Column:
    """A hash sample of about the given share (0 to 1, not null) of rows; fine enough for one row in 10^18."""
    return F.shiftrightunsigned(F.xxhash64(*by), 2) < (F.least(share.cast("double"), F.lit(1.0)) * 2.0**62).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """Columns ``_row`` (a unique long) and ``_doc`` (a struct of all columns of ``docs``).

    ``doc_id`` itself is the key where it is unique and never null. Otherwise (null ids,
    repeated rows) the rows are numbered once and stored, so each keeps its number.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias(ROW)).groupBy(ROW).agg(F.count(F.lit(1)).alias("n"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(DOC))
    if ids.where("_row IS NULL OR n > 1").isEmpty():
        return packed.select(F.col(f"{DOC}.doc_id").cast("long").alias(ROW), DOC)
    return store(packed.select(F.monotonically_increasing_id().alias(ROW), DOC), "rows")


def id_and_text(rows: DataFrame) -> DataFrame:
    """Columns ``_row``, ``doc_id``, ``text`` of keyed rows; a null text is empty."""
    return rows.select(
        ROW, F.col(f"{DOC}.doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"{DOC}.text"), F.lit("")).alias("text")
    )


def keep(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents, with their own columns, whose ``_row`` is in ``wanted``."""
    return rows.join(wanted.select(ROW), ROW, "left_semi").select(f"{DOC}.*")


def drop(rows: DataFrame, unwanted: DataFrame) -> DataFrame:
    """The documents, with their own columns, whose ``_row`` is not in ``unwanted``."""
    return rows.join(unwanted.select(ROW), ROW, "left_anti").select(f"{DOC}.*")


def id_order(doc_id: str = "doc_id", row: str = ROW) -> Column:
    """Order of documents: smallest id first, null ids last, then the row key."""
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc_id"), F.col(row).alias("row"))


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], buckets: int, name: str) -> DataFrame:
    """Number rows from 0 inside each group, a group never lying in one task.

    Rows are dealt into hash buckets of their order columns; the counts per bucket give
    each bucket's first number, and only a bucket is sorted. Every number follows from the
    rows alone, so a second run gives the same.
    """
    cell = "_cell"
    dealt = df.withColumn(cell, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    keys = [*group, cell]
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = dealt.withColumn("_at", F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1)
    return inside.join(starts, keys).withColumn(name, (F.col("_start") + F.col("_at")).cast("long")).drop(cell, "_at", "_start")


def placed(df: DataFrame, group: Sequence[str], cell: Column, order: Sequence[str], name: str) -> DataFrame:
    """Number rows from 0 in their order inside each group; null groups are groups, null values come first.

    ``cell`` cuts the order into ranges (it must not fall along ``order``): rows are numbered inside
    a cell and each cell starts at the rows of the cells before it, so a long group is many tasks.
    """
    dealt = df.withColumn("_cell", cell)
    counts = dealt.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_cell").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = dealt.withColumn("_at", F.row_number().over(W.partitionBy(*group, "_cell").orderBy(*order)) - 1)
    same = F.col("_cell").eqNullSafe(F.col("_c"))
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return inside.join(starts, same).withColumn(name, (F.col("_start") + F.col("_at")).cast("long")).select(*df.columns, name)


def streamed(df: DataFrame, read: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Pass each partition's rows, in order, through a generator; neither side holds more than one Arrow batch."""
    names, kinds = zip(*[f.split(" ") for f in schema.split(", ")])
    types = [pa.list_(ARROW_TYPES[k[6:-1]]) if k.startswith("array<") else ARROW_TYPES[k] for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        made = read(rows)
        while part := list(islice(made, ARROW_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=list(names))

    return df.mapInArrow(run, schema)
