"""Alert suppression: at most one alert per key within a window.

An alert is dropped when one of the same key was *emitted* less than the window
ago, so each decision depends on the previous emission. The chain for one key:
emit the first alert, jump to the first one at least a window later, repeat.
Alerts that were emitted before are facts: the chain starts anew behind each.

Keys of usual size follow the chain in one sorted pass that holds no group in
memory. The instants of larger ones are cut into blocks of equal length, which are read in
parallel: every block works out, for each instant that could be its first emission, where the
chain leaves the block; runs of entries with one exit collapse to a row. A sorted
pass over those rows gives each block the emission it starts from.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.functions.ordered import ordered, with_index
from strataward.functions.size import AUTO, KEY, SkewPolicy, find_hot

KEYS = ("alert_type", "dataset", "severity")
WINDOW_MINUTES = 30  # fixed value
NEVER = -(1 << 62)


def emitted_positions(times: np.ndarray, window: int, last: int = NEVER) -> list[int]:
    """Positions in sorted times that are emitted, given the last emission before them."""
    found = []
    i = int(np.searchsorted(times, last + window, "left")) if last != NEVER else 0
    while i < len(times):
        found.append(i)
        i = int(np.searchsorted(times, times[i] + window, "left"))
    return found


def block_runs(times: np.ndarray, window: int) -> list[tuple[int, int]]:
    """(largest entry, exit) per run of possible entries with one exit; the emission before is no later than the first instant."""
    n = len(times)
    following = np.searchsorted(times, times + window, "left")
    leaves = times.copy()
    for i in range(n - 1, -1, -1):
        if following[i] < n:
            leaves[i] = leaves[following[i]]
    entries = min(int(np.searchsorted(times, times[0] + window, "left")) + 1, n)
    runs: list[tuple[int, int]] = []
    for i in range(entries):
        if runs and runs[-1][1] == leaves[i]:
            runs[-1] = (int(times[i]), int(leaves[i]))
        else:
            runs.append((int(times[i]), int(leaves[i])))
    return runs


def _walk(window: int):
    """Keep emitted rows of batches sorted by group and time; one number of state, no group held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last = None, NEVER
        for batch in batches:
            groups, times = batch.column("_group").to_pylist(), batch.column("_us").to_pylist()
            starts = batch.column("_carry").to_pylist()
            keep, i, n = [], 0, len(groups)
            while i < n:
                if groups[i] != group:
                    group, last = groups[i], starts[i]
                end = bisect_right(groups, group, i, n)
                at = bisect_left(times, last + window, i, end)
                while at < end:
                    keep.append(at)
                    last = times[at]
                    at = bisect_left(times, last + window, at + 1, end)
                i = end
            yield batch.take(pa.array(keep, pa.int64()))

    return run


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batches(rows: Iterator[tuple], names: Sequence[str], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Rows of a key text and longs as Arrow batches."""
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield _batch(part, names)
            part = []
    if part:
        yield _batch(part, names)


def _batch(part: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    columns = list(zip(*part))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=list(names))


def _runs(window: int):
    """Runs of each block; rows come sorted by key, seed, block and time, and one block is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            (*block, entry, leave)
            for block, rows in groupby(_flat(batches), key=itemgetter(0, 1, 2))
            for entry, leave in block_runs(np.fromiter((r[3] for r in rows), np.int64), window)
        )
        return _batches(found, ("_key", "_seed", "_block", "entry", "leave"))

    return run


def _carries(window: int):
    """The emission before each block, from the runs in order; one number of state."""

    def carried(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (key, seed), own in groupby(rows, key=itemgetter(0, 1)):
            last = seed
            for block, entries in groupby(own, key=itemgetter(2)):
                yield key, seed, block, last
                for _, _, _, entry, leave in entries:
                    if last == NEVER or entry >= last + window:
                        last = leave
                        break

    return lambda batches: _batches(carried(_flat(batches)), ("_key", "_seed", "_block", "_carry"))


def _seeded(rows: DataFrame, emitted: DataFrame | None, keys: Sequence[str], policy: SkewPolicy) -> DataFrame:
    """Rows with ``_seed``: the last fact of the key up to the row's time."""
    if emitted is None:
        return rows.withColumn("_seed", F.lit(NEVER))
    facts = emitted.where(F.col("ts").isNotNull()).select(
        F.to_json(F.struct(*keys)).alias("_key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_us"), F.lit(None).cast("string").alias("alert_id")
    ).distinct()
    both = facts.withColumn("_fact", F.col("_us")).unionByName(rows.withColumn("_fact", F.lit(None).cast("long")))
    both = both.withColumn("_new", F.col("_fact").isNull())
    o = ordered(both, ["_key"], ["_us", "_new", "alert_id"], fill=["_fact"], policy=policy)
    out = o.df.withColumn("_seed", F.coalesce(o.filled("_fact"), F.lit(NEVER)))
    return o.finish(out).where("_new").select("_key", "_us", "alert_id", "_seed")


def _walked(rows: DataFrame, window: int, group: Sequence[str]) -> DataFrame:
    """Emitted rows, each group followed from its ``_carry`` in one sorted pass."""
    columns = rows.columns
    rows = rows.withColumn("_group", F.to_json(F.struct(*group)))
    dealt = rows.repartition("_group").sortWithinPartitions("_group", "_us", *[c for c in ("alert_id",) if c in columns])
    return dealt.mapInArrow(_walk(window), dealt.schema).select(*columns)


def _emitted_of_large(rows: DataFrame, window: int, policy: SkewPolicy, block_rows: int) -> DataFrame:
    """Emitted ids of large keys, their distinct instants in blocks of equal length."""
    instants = rows.select("_key", "_seed", "_us").distinct()
    at = with_index(instants, ["_key", "_seed"], ["_us"], "_at", policy)
    blocks = at.select("_key", "_seed", F.floor(F.col("_at") / block_rows).alias("_block"), "_us")
    order = ["_key", "_seed", "_block"]
    dealt = blocks.repartition(*order).sortWithinPartitions(*order, "_us")
    runs = dealt.mapInArrow(_runs(window), "_key string, _seed long, _block long, entry long, leave long")
    runs = runs.repartition("_key", "_seed").sortWithinPartitions(*order, "entry")
    carry = runs.mapInArrow(_carries(window), "_key string, _seed long, _block long, _carry long")
    emitted = _walked(blocks.join(carry, order), window, order).select("_key", "_us")
    # alerts of one instant count as one: the one with the least id
    return rows.join(emitted, ["_key", "_us"]).groupBy("_key", "_us").agg(F.min("alert_id").alias("alert_id")).select("alert_id")


def suppress_alerts(
    alerts: DataFrame,
    keys: Sequence[str] = KEYS,
    window_minutes: int = WINDOW_MINUTES,
    muted: Sequence[tuple[str, str]] = (),
    policy: SkewPolicy = AUTO,
    block_rows: int = 1_000_000,
    emitted: DataFrame | None = None,
) -> DataFrame:
    """Alerts that are emitted. ``alert_id`` must be unique; ``muted`` lists (type, dataset) pairs never emitted.

    ``emitted`` holds alerts emitted before (the key columns and ``ts``): they are not judged again, an
    alert less than the window after one of them is dropped, and the chain goes on from them.
    Alerts without a time have no place in the order: all of them are emitted and none counts
    for others. Only key, time and id are ordered; the other columns are fetched by the ids.
    """
    for kind, dataset in muted:
        alerts = alerts.where(~(F.col("alert_type").eqNullSafe(kind) & F.col("dataset").eqNullSafe(dataset)))
    window = window_minutes * 60_000_000
    undated = alerts.where(F.col("ts").isNull())
    alerts = alerts.where(F.col("ts").isNotNull())
    slim = alerts.select(F.to_json(F.struct(*keys)).alias("_key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_us"), "alert_id")
    rows = _seeded(slim, emitted, keys, policy)
    walk = lambda df: _walked(df.withColumn("_carry", F.col("_seed")), window, ["_key", "_seed"]).select("alert_id")
    hot = find_hot(slim, ["_key"], policy)
    if hot is None:
        found = walk(rows)
    else:
        large = hot.small(hot.table.select(F.col(KEY)["_key"].alias("_key")))
        found = walk(rows.join(large, "_key", "left_anti")).unionByName(_emitted_of_large(rows.join(large, "_key", "left_semi"), window, policy, block_rows))
    return alerts.join(found, "alert_id", "left_semi").select(*alerts.columns).unionByName(undated)
