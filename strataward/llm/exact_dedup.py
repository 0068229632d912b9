"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Sorting the distinct blocks gives each
an integer name; neighbouring names are then paired and the distinct pairs named in turn,
until one name is left. Documents of equal length class with the same last name are equal:
names stand for contents one to one, so no hash decides.

Only the first step moves text, and it moves distinct blocks, combined before the shuffle.
A block finds its name through a 64-bit address. The named blocks show whether an address
belongs to one block only; blocks whose address is shared are looked up by their content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataward.llm.common import ROW, WHITE, id_and_text, id_order, keep, keyed, store

BLOCK_BYTES = 4096
NO_PARTNER = -1
SHARED_FROM = 1 << 62  # names of blocks that were looked up by content


def normalised(text: Column) -> Column:
    """Each run of white space becomes one blank."""
    return F.regexp_replace(text, WHITE, " ")


def _blocks(texts: DataFrame, block_bytes: int, address) -> DataFrame:
    """One row per block: ``_row``, ``pos``, ``n`` (blocks of the text), ``block``, ``addr``."""
    cut = texts.select(ROW, F.encode("norm", "utf-8").alias("bytes")).withColumn(
        "n", F.greatest(F.ceil(F.octet_length("bytes") / block_bytes), F.lit(1)).cast("long")
    )
    cells = cut.select(ROW, "n", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("pos"))
    block = F.substring("bytes", (F.col("pos") * block_bytes + 1).cast("int"), F.lit(block_bytes))
    return cells.select(ROW, "pos", "n", block.alias("block")).withColumn("addr", address(F.col("block")))


def _name_distinct(distinct: DataFrame, by: list[str], name: str) -> DataFrame:
    """Sort distinct values inside their partitions; partition and place make the name."""
    return distinct.sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id())


def _named_blocks(texts: DataFrame, block_bytes: int, address) -> DataFrame:
    """Columns ``_row``, ``pos``, ``n``, ``name``, one row per block."""
    blocks = _blocks(texts, block_bytes, address)
    places = store(blocks.select(ROW, "pos", "n", "addr"), "blocks")
    names = store(_name_distinct(blocks.select("addr", "block").distinct(), ["block"], "name").select("addr", "name"), "names")
    found = names.groupBy("addr").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("k"))
    shared = found.where("k > 1").select("addr")
    if shared.isEmpty():
        return places.join(found.select("addr", "name"), "addr").select(ROW, "pos", "n", "name")
    shared = store(shared, "shared")
    again = blocks.join(shared, "addr", "left_semi")
    by_content = _name_distinct(again.select("block").distinct(), ["block"], "name").withColumn("name", F.col("name") + F.lit(SHARED_FROM))
    own = places.join(found.where("k = 1").select("addr", "name"), "addr").select(ROW, "pos", "n", "name")
    return own.unionByName(again.join(by_content, "block").select(ROW, "pos", "n", "name"))


def identities(texts: DataFrame, block_bytes: int = BLOCK_BYTES, address=F.xxhash64) -> DataFrame:
    """``_row``, ``level``, ``name`` for each row of ``texts`` (``_row``, ``norm``): equal pairs are equal texts.

    Texts of one block keep that block's name at level 0. Each further level halves the
    rest, so all levels together are a small multiple of the blocks. An empty text is one
    empty block. An empty table has no levels.
    """
    left = store(_named_blocks(texts, block_bytes, address), "level")
    levels = max((left.agg(F.max("n")).first()[0] or 1) - 1, 0).bit_length()
    done = left.where("n = 1").select(ROW, F.lit(0).alias("level"), "name")
    for level in range(1, levels + 1):
        pairs = (
            left.where("n > 1")
            .groupBy(ROW, F.shiftright("pos", 1).alias("pos"), F.shiftright(F.col("n") + 1, 1).alias("n"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("b"),
            )
        )
        names = _name_distinct(pairs.select("a", "b").distinct(), ["a", "b"], "name")
        left = store(pairs.join(names, ["a", "b"]).select(ROW, "pos", "n", "name"), "level")
        done = done.unionByName(left.where("n = 1").select(ROW, F.lit(level).alias("level"), "name"))
    return done


def exact_groups(rows: DataFrame, block_bytes: int = BLOCK_BYTES, address=F.xxhash64) -> DataFrame:
    """Groups of equal texts among keyed rows.

    Returns ``_row``, ``doc_id``, ``keep_id``, ``group_size``, ``kept``, one row per input row.
    A null text is empty. The smallest ``doc_id`` of a group stays; null ids come last, and
    of repeated rows with that id exactly one stays.
    """
    texts = id_and_text(rows).select(ROW, normalised(F.col("text")).alias("norm"))
    ids = id_and_text(rows).select(ROW, "doc_id")
    classed = store(identities(texts, block_bytes, address), "identities").join(ids, ROW)
    groups = classed.groupBy("level", "name").agg(F.min(id_order()).alias("first"), F.count(F.lit(1)).alias("group_size"))
    return classed.join(groups, ["level", "name"]).select(
        ROW, "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col(ROW) == F.col("first.row")).alias("kept")
    )


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document with its group and the SHA-256 of its normalised text.

    ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    rows = keyed(docs)
    digest = id_and_text(rows).select(ROW, F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    return exact_groups(rows, block_bytes).join(digest, ROW).drop(ROW)


def drop_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One document of each group of equal texts, with the columns of ``docs``."""
    rows = keyed(docs)
    return keep(rows, exact_groups(rows, block_bytes).where("kept"))
