"""Reproducible shuffle into shards: a Feistel permutation over global row numbers, with cycle walking.

A row's global number follows from its content. The permutation works on a grid of a * b
cells, just large enough for n rows: each round adds a keyed hash of one coordinate to the
other, modulo its side, so every round can be undone. A result of n or more is permuted
again until it falls below n, which visits each number below n once. Shard and slot are
the remainder and quotient of the permuted number, so counts differ by one at most and
anyone can compute a row's place, or the row of a place, without the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROUNDS = 6
WALKS = 64
BUCKET_ROWS = 200_000


def grid(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid that holds n cells."""
    a = max(1, int(n**0.5))
    while a * a < n:
        a += 1
    return a, max(1, -(-n // a))


def _once(x: Column, n: int, seed: int, backwards: bool = False) -> Column:
    """One pass of the permutation of the grid."""
    a, b = grid(n)
    start = F.array(F.pmod(x, F.lit(a)), F.floor(x / F.lit(a)).cast("long"))
    sign = -1 if backwards else 1

    def step(s: Column, i: Column) -> Column:
        left, right = s[0], s[1]
        dl = F.pmod(F.xxhash64(right, F.lit(seed), i), F.lit(a))
        dr = F.pmod(F.xxhash64(left, F.lit(seed), i), F.lit(b))
        even = F.array(F.pmod(left + sign * dl, F.lit(a)), right)
        odd = F.array(left, F.pmod(right + sign * dr, F.lit(b)))
        return F.when(i % 2 == 0, even).otherwise(odd)

    order = range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS)
    end = F.aggregate(F.array(*[F.lit(i) for i in order]), start, step)
    return F.aggregate(F.array(end), F.lit(0).cast("long"), lambda _, e: e[1] * a + e[0])


def permuted(x: Column, n: int, seed: int = 42, backwards: bool = False) -> Column:
    """A bijection of 0 .. n-1 (``backwards``: its inverse).

    The grid has fewer than sqrt(n) + 1 cells too many, so a walk ends after one pass for
    nearly all numbers; one that did not end after 64 would be an error, never a wrong place.
    """
    if n <= 1:
        return F.when(x.isNotNull(), F.lit(0).cast("long"))
    first = _once(x.cast("long"), n, seed, backwards)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), first, lambda y, _: F.when(y < n, y).otherwise(_once(y, n, seed, backwards))
    )
    out = F.when(first < n, first).otherwise(walk)
    return F.when(out < n, out).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long"))


def row_numbers(df: DataFrame, by: Sequence[str], buckets: int) -> DataFrame:
    """Distinct rows of ``by`` with ``n`` (repeats) and ``row``, the global number of the first of them.

    Repeats are combined before the shuffle. Rows are dealt to hash buckets; bucket counts
    give each bucket's first number, so no task sorts more than a bucket.
    """
    cell = F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")
    distinct = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("cell", cell)
    starts = distinct.groupBy("cell").agg(F.sum("n").alias("size")).select(
        "cell", F.coalesce(F.sum("size").over(W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start")
    )
    inside = W.partitionBy("cell").orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    at = distinct.withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return at.join(starts, "cell").withColumn("row", F.col("start") + F.col("at")).drop("cell", "start", "at")


def shard_rows(df: DataFrame, by: Sequence[str], shards: int = 24, seed: int = 42) -> DataFrame:
    """The columns ``by`` of every row of ``df``, with ``row``, ``shard`` and ``slot``.

    Deterministic in the rows' content; which of several wholly equal rows takes which of
    their places makes no difference. Nulls are ordinary values. An empty table gives an
    empty result. Hot values only repeat in an explode of integers.
    """
    total = df.count()
    buckets = max(64, -(-total // BUCKET_ROWS))
    runs = row_numbers(df, by, buckets)
    rows = runs.select(*by, F.explode(F.sequence(F.col("row"), F.col("row") + F.col("n") - 1)).alias("row"))
    placed = rows.withColumn("place", permuted(F.col("row"), total, seed))
    return placed.select(
        *by, "row", F.pmod("place", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("place") / shards).cast("long").alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 42) -> DataFrame:
    """Every document's ``size`` (UTF-8 bytes of its text plus 8), ``text_crc32`` and place under the law ``rows``.

    Only ids, sizes and checksums are shuffled, never texts. A null text has no bytes.
    """
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")).alias("text_crc32"),
    )
    placed = shard_rows(facts, ["doc_id", "size", "text_crc32"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
