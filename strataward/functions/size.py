"""Size checks that decide between plans."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataward.session import scratch_path

BROADCAST_LIMIT = 64 << 20
BROADCAST_KEYS = 500_000
KEY = "_sw_key"


@dataclass(frozen=True)
class SkewPolicy:
    """When an ordered group is too large for one task.

    mode "auto" measures, "bounded" asserts that the caller knows every group is
    small, "blocks" splits every group.
    """

    mode: str = "auto"
    small_bytes: int = 32 << 20
    max_group_rows: int = 4_000_000
    block_rows: int = 4_000_000


@dataclass(frozen=True)
class Hot:
    """Groups over the limit.

    ``table`` has one row per hot key: the key, its rows and any figures asked for.
    ``count`` is its measured length, so tables per hot key have a known size.
    """

    limit: int
    count: int | None
    table: DataFrame

    def small(self, df: DataFrame) -> DataFrame:
        """Broadcast a table with a few rows per hot key, where their number is known to be small."""
        return F.broadcast(df) if self.count is not None and self.count <= BROADCAST_KEYS else df


def key_column(keys: Sequence[str]) -> Column:
    """One null-safe grouping value for any number of keys (none = whole frame)."""
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


AUTO = SkewPolicy()
BOUNDED = SkewPolicy(mode="bounded")


def plan_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate, or None where it may be too low."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if "Generate " in plan.toString():
        return None  # exploding adds rows that the estimate leaves out
    return int(str(plan.stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the stored and in-memory inputs a plan reads.

    Unlike the plan estimate this does not multiply over joins.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def not_growing(df: DataFrame) -> bool:
    """Whether no step of the plan can give more rows than it reads."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return not any(word in plan for word in ("Generate ", "Join ", "Expand ", "MapInArrow", "FlatMap"))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint behind a size check; otherwise the join strategy stays adaptive."""
    size = plan_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def find_hot(df: DataFrame, keys: Sequence[str], policy: SkewPolicy, figures: dict[str, Column] | None = None) -> Hot | None:
    """Whether some key groups have more rows than one task should order.

    Small inputs that no join or explode can enlarge are settled from their stored size
    (packed columns rarely hold more than a few rows a byte). All others cost one
    pre-aggregated count by key; the hot keys are written to the shared folder, so
    that they are found once. Only the choice of plan depends on this; the result
    does not.
    """
    if policy.mode == "bounded" or (policy.mode == "auto" and not_growing(df) and input_bytes(df) <= policy.small_bytes):
        return None
    limit = policy.max_group_rows if policy.mode == "auto" else 0
    extra = [c.alias(n) for n, c in (figures or {}).items()]
    counts = df.groupBy(key_column(keys).alias(KEY)).agg(F.count(F.lit(1)).alias("_sw_n"), *extra)
    table = counts.where(F.col("_sw_n") > limit)
    if policy.mode != "auto":
        return Hot(limit, None, table)
    path = scratch_path(df.sparkSession, "hot")
    table.write.parquet(path)
    stored = df.sparkSession.read.schema(table.schema).parquet(path)
    n = stored.count()
    return Hot(limit, n, stored) if n else None


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    """No rows with a schema; known to be empty, so the optimizer drops what depends on it."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
