"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    down = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return down.unionByName(least.select(F.col("m").alias("a"), "b"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``links`` (``a``, ``b``).

    Links may repeat, run either way, or join a node with itself. Neighbours are reduced by
    aggregates and joined back, never gathered, so a node with very many links is no problem.
    The rounds end when the links no longer change; each round is stored.
    """
    edges = store(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars"
    )
    mark = _mark(edges)
    while True:
        large = _large_star(edges).where("a < b").distinct()
        edges = store(_small_star(large).where("a < b").distinct(), "stars")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    ).groupBy("node").agg(F.min("component").alias("component"))
