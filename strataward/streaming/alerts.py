"""Streaming alert suppression with the last emission per key as state, and timers that end it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strataward.operators.suppression import KEYS, NEVER, WINDOW_MINUTES

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATENESS = "10 minutes"
BUCKETS = 1024


class _LastEmission(StatefulProcessor):
    """One row per key of a bucket, from an emission until the watermark has passed its window.

    The worker's cost is by group, whatever its rows, so a group is a bucket of keys. Its only timer
    stands at the earliest end among its keys.
    """

    def __init__(self, window_us: int, columns: Sequence[str]):
        self.window_us = window_us
        self.columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getListState("last_us", "sw_key string, us long")

    def _ends(self, last: int) -> int:
        return (last + self.window_us) // 1000 + 1

    def _timer(self, held: dict[str, int]) -> int | None:
        return self._ends(min(held.values())) if held else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = dict(self.last.get())
        timer = self._timer(held)
        parts = []
        for p in rows:
            # rows that can still be emitted, one for each instant of a key and part
            last = np.array([held.get(k, NEVER) for k in p["sw_key"]], np.int64)
            parts.append(p[p["sw_us"].to_numpy() >= last + self.window_us].sort_values(["sw_us", "alert_id"]).drop_duplicates(["sw_key", "sw_us"]))
        if not parts:
            return
        batch = pd.concat(parts).sort_values(["sw_us", "alert_id"])
        keep = []
        for i, (k, us) in enumerate(zip(batch["sw_key"].tolist(), batch["sw_us"].tolist())):
            if us >= held.get(k, NEVER) + self.window_us:
                keep.append(i)
                held[k] = us
        if not keep:
            return
        if self._timer(held) != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(self._timer(held))
        self.last.put(list(held.items()))
        yield batch.iloc[keep][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = {k: us for k, us in self.last.get() if self._ends(us) > now}
        if held:
            self.handle.registerTimer(self._timer(held))
            self.last.put(list(held.items()))
        else:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def suppress_stream(
    alerts: DataFrame, keys: Sequence[str] = KEYS, window_minutes: int = WINDOW_MINUTES, lateness: str = LATENESS, buckets: int = BUCKETS
) -> DataFrame:
    """Emitted alerts of a stream, with all their columns.

    The state of a key ends when the watermark (the newest time, less ``lateness``) has passed the window of its last
    emission, so it holds only keys with a recent alert. Late alerts: one from before the last
    emission of its key, or less than the window after it, is dropped; so is one older than the
    watermark. Alerts without a time are all emitted. Keys are dealt by hash to ``buckets``, whose number
    stays with a checkpoint; a task holds the new rows and the state of one bucket at a time.
    The session needs the RocksDB state store (``STATE_STORE``).
    """
    columns = alerts.columns
    # names without an underscore in front: the stateful worker renames such columns
    key = F.to_json(F.struct(*keys))
    dated = alerts.where(F.col("ts").isNotNull()).select(
        "*", F.pmod(F.xxhash64(key), F.lit(buckets)).alias("sw_bucket"), key.alias("sw_key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("sw_us"), F.col("ts").cast("timestamp").alias("sw_at")
    )
    emitted = dated.withWatermark("sw_at", lateness).groupBy("sw_bucket").transformWithStateInPandas(
        statefulProcessor=_LastEmission(window_minutes * 60_000_000, columns), outputStructType=alerts.schema, outputMode="append", timeMode="eventTime",
    )
    return emitted.select(*columns).unionByName(alerts.where(F.col("ts").isNull()))
