"""Exact per-key quantiles that never hold one key's values in one task.

The usual plan is Spark's ``percentile`` aggregate. For large groups: radix selection on an
order-preserving 64-bit form of the values. Each round counts rows by the next 12 bits below
the prefixes that hold a wanted rank, so a prefix has at most 4096 counts, whatever the
values are. A rank is found when its bucket holds one value only (a constant column: at once)
or when the bucket is small enough for its values to be ranked in a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataward.functions.size import AUTO, KEY, Hot, SkewPolicy, find_hot, key_column
from strataward.session import stored_frame

SHIFTS = (52, 40, 28, 16, 4, 0)  # bits left below the prefix after each round
_NAN = 2048 * (1 << 52) - 1  # above infinity


def _code(values: pa.Array) -> pa.Array:
    v = values.to_numpy(zero_copy_only=False)
    bits = v.view(np.int64) & np.int64((1 << 63) - 1)
    return pa.array(np.where(np.isnan(v), _NAN, np.where(v < 0, -bits, bits)), mask=values.is_null().to_numpy(zero_copy_only=False))


def order_code(value: Column) -> Column:
    """A long in the order of the doubles: sign, exponent and mantissa; NaN last, both zeros 0.

    One evaluation a row: the optimizer would copy a deterministic form into every filter and key.
    """
    return F.arrow_udf(_code, T.LongType()).asNondeterministic()(value)


def key_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    method: str = "cont",
    policy: SkewPolicy = AUTO,
) -> DataFrame:
    """One row per key with one column per probability.

    method "cont" interpolates linearly, "disc" returns an existing value.
    """
    if method not in ("cont", "disc"):
        raise ValueError(f"unknown quantile method {method}")
    keys = list(keys)
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    hot = find_hot(data, keys, policy)
    if hot is None:
        return _grouped(data, keys, probs, names, method)
    if not hot.limit:
        return _ranked(data, keys, probs, names, method, hot, policy.block_rows)
    # hot keys are few: their rows take the ranked plan, all others the aggregate
    large = hot.small(hot.table.select(KEY))
    keyed = data.withColumn(KEY, key_column(keys))
    cold = _grouped(keyed.join(large, KEY, "left_anti").select(*keys, "_v"), keys, probs, names, method)
    split = keyed.join(large, KEY, "left_semi").select(*keys, "_v")
    return cold.unionByName(_ranked(split, keys, probs, names, method, hot, policy.block_rows))


def ranked_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str], hot: Hot, policy: SkewPolicy = AUTO
) -> DataFrame:
    """Interpolated quantiles of large groups only."""
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    return _ranked(data, list(keys), probs, names, "cont", hot, policy.block_rows)


def _grouped(data, keys, probs, names, method) -> DataFrame:
    if method == "cont":
        wanted = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs]))
        table = data.groupBy(*keys).agg(wanted.alias("_q"))
        return table.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    aggs = [
        F.expr(f"percentile_disc({float(p)}) WITHIN GROUP (ORDER BY _v)").alias(n) for p, n in zip(probs, names)
    ]
    return data.groupBy(*keys).agg(*aggs)


def _wanted(total: Column, probs: Sequence[float], method: str) -> Column:
    """The ranks that make each quantile: one, or the two around it with the share of the upper one."""
    kinds = []
    for i, p in enumerate(probs):
        if method == "disc":
            at = F.greatest(F.ceil(total * p) - 1, F.lit(0)).cast("long")
            kinds.append(F.struct(F.lit(i).alias("q"), F.lit(0).alias("hi"), at.alias("at"), F.lit(0.0).alias("frac")))
            continue
        pos = (total - 1) * F.lit(float(p))
        for hi, edge in ((0, F.floor), (1, F.ceil)):
            kinds.append(F.struct(F.lit(i).alias("q"), F.lit(hi).alias("hi"), edge(pos).cast("long").alias("at"), (pos - F.floor(pos)).alias("frac")))
    return F.array(*kinds)


def _narrowed(rows: DataFrame, wanted: DataFrame, prefix: Column, shift: int, hot: Hot) -> DataFrame:
    """One round: the bucket under ``_b`` that holds each wanted rank, with its rows and its least and greatest value."""
    hist = rows.groupBy(KEY, prefix.alias("_b"), F.shiftright("_c", shift).alias("_next")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    earlier = Window.partitionBy(KEY, "_b").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    inside = hist.join(hot.small(wanted), [KEY, "_b"]).where((F.col("at") >= F.col("_before")) & (F.col("at") < F.col("_before") + F.col("_n")))
    return inside.select(KEY, F.col("_next").alias("_b"), "q", "hi", "frac", (F.col("at") - F.col("_before")).alias("at"), "_n", "_low", "_high")


def _found_values(data: DataFrame, probs: Sequence[float], method: str, hot: Hot, task_rows: int) -> DataFrame:
    """``KEY``, ``q``, ``hi``, ``frac``, ``_v`` of every wanted rank."""
    v = F.col("_v") + 0.0  # one zero
    rows = data.select(KEY, v.alias("_v"), order_code(v).alias("_c"))
    totals = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("_total"))
    wanted = totals.select(KEY, F.lit(0).cast("long").alias("_b"), F.inline(_wanted(F.col("_total"), probs, method)))
    found, prefix = [], F.lit(0).cast("long")
    for shift in SHIFTS:
        reached = stored_frame(_narrowed(rows, wanted, prefix, shift, hot), "ranks")
        single = F.col("_low").eqNullSafe(F.col("_high"))
        found.append(reached.where(single).select(KEY, "q", "hi", "frac", F.col("_low").alias("_v")))
        wanted = reached.where(~single)
        largest = wanted.agg(F.max("_n")).first()[0]
        if largest is None:
            break
        prefix = F.shiftright("_c", shift)
        near = hot.small(wanted.select(KEY, "_b").distinct())
        rows = rows.withColumn("_b", prefix).join(near, [KEY, "_b"], "left_semi").select(KEY, "_v", "_c")
        if shift == SHIFTS[0]:
            rows = stored_frame(rows, "near")  # later rounds don't read the source again
        if largest <= task_rows:
            counts = rows.groupBy(KEY, prefix.alias("_b"), "_v").agg(F.count(F.lit(1)).alias("_m"))
            so_far = Window.partitionBy(KEY, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            hit = wanted.join(counts.withColumn("_upto", F.sum("_m").over(so_far)), [KEY, "_b"])
            hit = hit.where((F.col("at") >= F.col("_upto") - F.col("_m")) & (F.col("at") < F.col("_upto")))
            found.append(hit.select(KEY, "q", "hi", "frac", "_v"))
            break
        wanted = wanted.drop("_n", "_low", "_high")
    return reduce(DataFrame.unionByName, found)


def _ranked(data, keys, probs, names, method, hot: Hot, task_rows: int) -> DataFrame:
    hit = _found_values(data.select(key_column(keys).alias(KEY), "_v"), probs, method, hot, task_rows)
    cols = []
    for i, name in enumerate(names):
        low = F.max(F.when((F.col("q") == i) & (F.col("hi") == 0), F.col("_v")))
        if method == "disc":
            cols.append(low.alias(name))
            continue
        high = F.max(F.when((F.col("q") == i) & (F.col("hi") == 1), F.col("_v")))
        frac = F.max(F.when(F.col("q") == i, F.col("frac")))
        cols.append(F.when((low == high) | (frac == 0), low).otherwise(low * (1 - frac) + high * frac).alias(name))
    out = hit.groupBy(KEY).agg(*cols)
    return out.select(*[F.col(KEY)[k].alias(k) for k in keys], *names)
