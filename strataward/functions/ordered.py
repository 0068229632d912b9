"""Ordered per-key computation that holds when one key has most of the rows.

``ordered(df, keys, order_by, ...)`` hands back a frame plus a window to use on
it. Normally that is one window per key. When a key group is too large for one
task, each group is cut into equal blocks along its order instead:

1. rows get an exact position in their group: a time-bucket row number plus the
   count of all earlier buckets of that key;
2. forward-filled values carry over bucket borders from a per-bucket summary;
3. the last ``halo`` rows of a block are repeated at the head of the next block,
   so look-back frames see the rows they need.

A group under the limit stays whole in block 0 and keeps its window statistics.
Statistics of split groups are aggregated, and joined back from one row per hot
key. Operators write one window expression for both forms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataward.functions.size import AUTO, BROADCAST_KEYS, KEY, Hot, SkewPolicy, find_hot, key_column
from strataward.session import stored_frame

BUCKETS_A_BLOCK, SAMPLE_A_BUCKET = 4, 64
FANOUT = 256  # parts of a bucket on each level of the splitter tree
BROADCAST_CUTS = 500_000
BUCKET, INDEX, BLOCK, HALO, IS_HOT = "_sw_bucket", "_sw_index", "_sw_block", "_sw_halo", "_sw_hot"


def whole_group(keys: Sequence[str]) -> list:
    """Window partition of a group that fits one task."""
    return list(keys) or [F.lit(0)]


Build = Callable[[Callable[[Column], Column]], dict[str, Column]]


class Ordered:
    """Frame and window over ordered key groups."""

    def __init__(
        self, df: DataFrame, keys: list[str], window, hot: Hot | None, fill: Sequence[str], temps: list[str]
    ):
        self.df = df
        self.keys = keys
        self.window = window
        self.hot = hot
        # plain columns where possible, so that a partitioning by key is reused before and after
        self.group = whole_group(keys) if hot is None else [KEY, BLOCK]
        self._fill = set(fill)
        self._temps = temps

    def filled(self, name: str) -> Column:
        """Last non-null value of ``name`` up to and including the row."""
        if name not in self._fill:
            raise ValueError(f"{name} was not requested in fill")
        return F.col(f"_sw_fill_{name}")

    def with_cold_stats(self, df: DataFrame, build: Build) -> DataFrame:
        """Add aggregates of whole groups, null for rows of split groups."""
        if self.hot is not None and not self.hot.limit:  # no group is whole
            empty = df.agg(*[agg.alias(name) for name, agg in build(lambda c: c).items()]).schema
            return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in empty})
        on = (lambda c: c) if self.hot is None else (lambda c: F.when(~F.col(IS_HOT), c))
        whole = Window.partitionBy(*self.group)
        return df.select("*", *[agg.over(whole).alias(name) for name, agg in build(on).items()])

    def with_key_stats(self, df: DataFrame, build: Build) -> DataFrame:
        """Add whole-group aggregates to each row.

        ``build`` gets a function that wraps each aggregated column and returns
        the aggregates by name. Whole groups use the window's own shuffle.
        """
        out = self.with_cold_stats(df, build)
        if self.hot is None:
            return out
        rows = df.where(F.col(IS_HOT) & ~F.col(HALO))
        return self.with_hot_table(out, rows.groupBy(KEY).agg(*[agg.alias(n) for n, agg in build(lambda c: c).items()]))

    def with_hot_table(self, df: DataFrame, table: DataFrame) -> DataFrame:
        """Put values of a table with one row per hot key in place of the null ones."""
        names = [c for c in table.columns if c != KEY]
        values = table.select(KEY, *[F.col(n).alias(f"_h{n}") for n in names])
        out = df.join(self.hot.small(values), KEY, "left")
        return out.withColumns({n: F.coalesce(n, f"_h{n}") for n in names}).drop(*[f"_h{n}" for n in names])

    def hot_rows(self, source: DataFrame) -> DataFrame:
        """Rows of the split groups, with their key."""
        keyed = source.withColumn(KEY, key_column(self.keys))
        return keyed.join(self.hot.small(self.hot.table.select(KEY)), KEY, "left_semi")

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop repeated rows and helper columns."""
        if HALO in df.columns:
            df = df.where(~F.col(HALO))
        return df.drop(*[c for c in self._temps if c in df.columns])


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    fill: Sequence[str] = (),
    halo: int = 0,
    policy: SkewPolicy = AUTO,
) -> Ordered:
    """Prepare ordered groups. ``order_by`` must be unique within a key."""
    keys, order_by = list(keys), list(order_by)
    if not order_by:
        raise ValueError("order_by is required")
    hot = find_hot(df, keys, policy)
    if hot:
        return _blocks(df, keys, order_by, fill, halo, policy, hot)
    window = Window.partitionBy(*whole_group(keys)).orderBy(*order_by)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = [F.last(c, ignorenulls=True).over(so_far).alias(f"_sw_fill_{c}") for c in fill]
    temps = [f"_sw_fill_{c}" for c in fill]
    return Ordered(df.select("*", *filled) if filled else df, keys, window, None, fill, temps)


def unordered(df: DataFrame, keys: Sequence[str], policy: SkewPolicy = AUTO) -> Ordered:
    """Groups for whole-key statistics only; rows of hot keys are spread by hash."""
    keys = list(keys)
    hot = find_hot(df, keys, policy)
    if hot is None:
        return Ordered(df, keys, None, None, (), [])
    base = df.withColumn(KEY, key_column(keys))
    spread = F.when(F.col(IS_HOT), F.pmod(F.xxhash64(*df.columns), F.lit(4096))).otherwise(F.lit(0))
    out = (
        base.join(hot.small(hot.table.select(KEY, F.lit(True).alias(IS_HOT))), KEY, "left")
        .withColumn(IS_HOT, F.coalesce(IS_HOT, F.lit(False)))
        .withColumns({BLOCK: spread, HALO: F.lit(False)})
    )
    return Ordered(out, keys, None, hot, (), [KEY, IS_HOT, BLOCK, HALO])


def with_index(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str = "row_index",
    policy: SkewPolicy = AUTO,
) -> DataFrame:
    """Exact 0-based position of each row within its key."""
    keys, order_by = list(keys), list(order_by)
    hot = find_hot(df, keys, policy)
    if hot:
        o = _blocks(df, keys, order_by, (), 0, policy, hot)
        return o.finish(o.df.withColumn(name, F.col(INDEX)))
    window = Window.partitionBy(*whole_group(keys)).orderBy(*order_by)
    return df.withColumn(name, (F.row_number().over(window) - 1).cast("long"))


def _sizes(hot: Hot, block_rows: int) -> DataFrame:
    """Rows and wanted buckets of each hot key."""
    buckets = F.ceil(F.col("_sw_n") * BUCKETS_A_BLOCK / block_rows).cast("long")
    return hot.table.select(KEY, F.col("_sw_n").alias("_sw_n"), buckets.alias("_sw_nb"))


def _cuts(rows: DataFrame, order_by: list[str], level: int) -> DataFrame:
    """Cut points of each bucket of the level above: order tuples at even ranks of a hash sample.

    A bucket is cut into ``FANOUT`` parts at most, from about 64 sampled rows a part, so no
    array is longer than that, whatever the size of the key. Cuts only steer the work.
    """
    above = F.lit(float(FANOUT) ** level)
    fan = F.least(F.ceil(F.col("_sw_nb") / above), F.lit(FANOUT)).cast("int")
    share = F.least(F.lit(1.0), fan * SAMPLE_A_BUCKET * above / F.col("_sw_n"))
    chosen = F.shiftrightunsigned(F.xxhash64(F.lit(level), KEY, *order_by), 2) < (share * 2.0**62).cast("long")
    bucket = Window.partitionBy(KEY, BUCKET)
    # ranked by a sort: lists of all sampled rows would be built, and sorted, on both sides of the shuffle
    sampled = rows.where(F.col(IS_HOT) & (fan > 1) & chosen).select(KEY, BUCKET, *order_by, fan.alias("_sw_fan"))
    ranked = sampled.select(
        "*", (F.row_number().over(bucket.orderBy(*order_by)) - 1).alias("_sw_at"), F.count(F.lit(1)).over(bucket).alias("_sw_s")
    )
    part = F.ceil(F.col("_sw_at") * F.col("_sw_fan") / F.col("_sw_s"))
    cuts = ranked.where((part > 0) & (part < F.col("_sw_fan")) & (F.floor(F.col("_sw_s") * part / F.col("_sw_fan")) == F.col("_sw_at")))
    return cuts.groupBy(KEY, BUCKET).agg(F.array_sort(F.array_distinct(F.collect_list(F.struct(*order_by)))).alias("_sw_cuts"))


def _below_cuts(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """Rows with ``_sw_found``: how many of their sorted cuts (fewer than ``FANOUT``) are below them, by halving steps.

    A column for each step, as each is used twice by the next: they run as compiled code, which a
    lambda over an array does not.
    """
    value = F.struct(*order_by)
    rows = rows.withColumn("_sw_found", F.lit(0))
    for b in range(1, FANOUT.bit_length()):
        found, s = F.col("_sw_found"), FANOUT >> b
        here = F.get("_sw_cuts", found + (s - 1))
        rows = rows.withColumn("_sw_found", found + F.when(here < value, F.lit(s)).otherwise(F.lit(0)))
    return rows


def _bucketed(base: DataFrame, order_by: list[str], hot: Hot, block_rows: int) -> DataFrame:
    """Rows with the bucket of their hot key, numbered along the order; 0 for all others."""
    rows = split_along(base, order_by, _sizes(hot, block_rows), hot.count).drop("_sw_n", "_sw_nb")
    return stored_frame(rows, "buckets") if _storable(rows) else rows  # counted, numbered and summed from here


def _storable(df: DataFrame) -> bool:
    """Whether Parquet takes every type (a column's name may say no as well, which only costs time)."""
    return not any(word in df.schema.simpleString() for word in ("void", "interval"))


def split_along(base: DataFrame, order_by: list[str], sizes: DataFrame, count: int | None) -> DataFrame:
    """Rows of the keys in ``sizes`` (``KEY``, ``_sw_n`` rows, ``_sw_nb`` buckets wanted) in even buckets along an order.

    Splitters are a tree of rows, not an array per key: each level cuts the buckets of the one above,
    and a row's bucket is its path. One level does for 256 buckets, three for 16 million. ``count``: the
    number of keys where it is known, which decides about broadcasts.
    """
    found = sizes.agg(F.max("_sw_nb").alias("most"), F.sum("_sw_nb").alias("all")).first()
    most, total = found["most"] or 1, found["all"] or 0
    few = count is not None and count <= BROADCAST_KEYS
    wide, small = (F.broadcast if few else (lambda df: df)), (F.broadcast if few and total <= BROADCAST_CUTS else (lambda df: df))
    rows = base.join(wide(sizes), KEY, "left").withColumns({IS_HOT: F.col("_sw_nb").isNotNull(), BUCKET: F.lit(0).cast("long")})
    level = 0
    while level == 0 or FANOUT**level < most:
        cuts = _cuts(rows, order_by, level)
        if FANOUT < most:
            cuts = stored_frame(cuts, "cuts")  # levels below read this one again
        rows = _below_cuts(rows.join(small(cuts), [KEY, BUCKET], "left"), order_by)
        rows = rows.withColumn(BUCKET, F.col(BUCKET) * FANOUT + F.col("_sw_found")).drop("_sw_cuts", "_sw_found")
        level += 1
        if FANOUT**level < most and _storable(rows):
            rows = stored_frame(rows, "buckets")  # the levels below would repeat this one
    return rows


def _blocks(df, keys, order_by, fill, halo, policy, hot: Hot) -> Ordered:
    # a group under the limit must fit block 0
    block_rows = max(policy.block_rows, hot.limit, halo + 1)
    base = df.withColumn(KEY, key_column(keys))
    order = F.struct(*order_by)
    rows = _bucketed(base, order_by, hot, block_rows)

    summary = (
        rows.where(F.col(IS_HOT))
        .groupBy(KEY, BUCKET)
        .agg(
            F.count(F.lit(1)).alias("_sw_rows"),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_sw_last_{c}") for c in fill],
        )
    )
    earlier = Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        KEY,
        BUCKET,
        F.sum("_sw_rows").over(earlier).alias("_sw_offset"),
        *[F.last(f"_sw_last_{c}", ignorenulls=True).over(earlier).alias(f"_sw_carry_{c}") for c in fill],
    )

    inside = Window.partitionBy(KEY, BUCKET).orderBy(*order_by)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.select(
        *df.columns,
        KEY,
        BUCKET,
        IS_HOT,
        (F.row_number().over(inside) - 1).alias("_sw_rn"),
        *[F.last(c, ignorenulls=True).over(so_far).alias(f"_sw_in_{c}") for c in fill],
    ).join(carry, [KEY, BUCKET], "left")
    out = numbered.select(
        *df.columns,
        KEY,
        IS_HOT,
        (F.col("_sw_rn") + F.coalesce("_sw_offset", F.lit(0))).cast("long").alias(INDEX),
        *[F.coalesce(f"_sw_in_{c}", f"_sw_carry_{c}").alias(f"_sw_fill_{c}") for c in fill],
    )
    temps = [KEY, INDEX, IS_HOT] + [f"_sw_fill_{c}" for c in fill]
    if not halo:
        return Ordered(out, keys, None, hot, fill, temps)

    own = F.floor(F.col(INDEX) / block_rows).cast("long")
    targets = F.when(
        F.col(INDEX) % block_rows >= block_rows - halo, F.array(own, own + 1)
    ).otherwise(F.array(own))
    out = out.withColumn(BLOCK, F.explode(targets)).withColumn(HALO, F.col(BLOCK) != own)
    window = Window.partitionBy(KEY, BLOCK).orderBy(INDEX)
    return Ordered(out, keys, window, hot, fill, temps + [BLOCK, HALO])


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


