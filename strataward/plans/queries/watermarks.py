"""Watermark table over event types."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.operators import watermark as W
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry
from strataward.session import scratch_path

REGISTRY = Registry()
query = REGISTRY.query

# a first load up to the 15th without errors, then updates of every type, counted for errors only
_STORED = """st AS (SELECT event_type AS dataset, CAST(max(ts) AS DATE) AS last_update_date, count(*) AS record_count,
   TIMESTAMP '2024-01-15 12:00:00' AS created_at, TIMESTAMP '2024-01-15 12:00:00' AS updated_at
   FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'error' GROUP BY 1)"""
_MERGED = _STORED + """, up AS (SELECT event_type AS dataset, CAST(max(ts) AS DATE) AS last_update_date, CAST(CASE WHEN event_type = 'error' THEN count(*) END AS BIGINT) AS record_count,
   CAST(max(ts) AS TIMESTAMP) AS updated_at FROM events GROUP BY 1),
 mg AS (SELECT coalesce(st.dataset, up.dataset) AS dataset, coalesce(up.last_update_date, st.last_update_date) AS last_update_date,
   coalesce(up.record_count, st.record_count) AS record_count, coalesce(st.created_at, up.updated_at) AS created_at,
   coalesce(up.updated_at, st.updated_at) AS updated_at FROM st FULL JOIN up ON st.dataset = up.dataset)"""


def _stored(spark, d):
    e = X.table(spark, d, "events").where((F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")) & (F.col("event_type") != "error"))
    first = e.groupBy(F.col("event_type").alias("dataset")).agg(
        F.max(F.col("ts").cast("date")).alias("last_update_date"), F.count(F.lit(1)).alias("record_count")
    ).withColumn("updated_at", F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return W.merge_watermarks(W.empty_watermarks(spark), first)


def _updates(spark, d):
    e = X.table(spark, d, "events")
    # one update per day; the newest counts
    days = e.groupBy(F.col("event_type").alias("dataset"), F.col("ts").cast("date").alias("last_update_date")).agg(
        F.max("ts").alias("updated_at")
    )
    total = e.groupBy(F.col("event_type").alias("dataset")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(total, "dataset").select(
        "dataset", "last_update_date", F.when(F.col("dataset") == "error", F.col("n")).alias("record_count"), "updated_at"
    )


def _merged(spark, d):
    return W.merge_watermarks(_stored(spark, d), _updates(spark, d))


@query("merge_watermarks", f"WITH {_MERGED} SELECT * FROM mg")
def _(spark, d):
    return _merged(spark, d)


@query("save_watermarks", f"WITH {_MERGED} SELECT * FROM mg")
def _(spark, d):
    path = scratch_path(spark, "watermarks")
    W.save_watermarks(_stored(spark, d), path)
    W.save_watermarks(W.merge_watermarks(W.load_watermarks(spark, path), _updates(spark, d)), path)
    return W.load_watermarks(spark, path)


@query("watermark_of", f"WITH {_MERGED} SELECT * FROM mg WHERE dataset = 'click'")
def _(spark, d):
    return W.watermark_of(_merged(spark, d), "click")


@query("remove_watermark", f"WITH {_MERGED} SELECT * FROM mg WHERE dataset <> 'click'")
def _(spark, d):
    return W.remove_watermark(_merged(spark, d), "click")


@query("watermark_summary", f"WITH {_MERGED} SELECT * FROM mg ORDER BY updated_at DESC")
def _(spark, d):
    return W.watermark_summary(_merged(spark, d))


@query(
    "watermark_totals",
    f"WITH {_MERGED} SELECT count(*) AS datasets, CAST(sum(record_count) AS BIGINT) AS records, min(last_update_date) AS oldest, max(last_update_date) AS newest FROM mg",
)
def _(spark, d):
    return W.watermark_totals(_merged(spark, d))


@query(
    "advance_only",
    f"""WITH {_STORED}, c AS (SELECT DISTINCT event_type AS dataset, CAST(ts AS DATE) AS last_update_date FROM events)
    SELECT c.dataset, c.last_update_date FROM c LEFT JOIN st ON c.dataset = st.dataset
    WHERE st.dataset IS NULL OR c.last_update_date >= st.last_update_date""",
)
def _(spark, d):
    candidates = X.table(spark, d, "events").select(
        F.col("event_type").alias("dataset"), F.col("ts").cast("date").alias("last_update_date")
    ).distinct()
    return W.advance_only(_stored(spark, d), candidates)


@query(
    "resume_from",
    f"""WITH {_MERGED}, p AS (SELECT event_type AS dataset, min(CAST(ts AS DATE)) AS start_date FROM events GROUP BY 1)
    SELECT p.dataset, coalesce(last_update_date + 1, start_date) AS resume_date, DATE '2024-01-20' AS end_date,
    coalesce(last_update_date + 1, start_date) > DATE '2024-01-20' AS skip FROM p LEFT JOIN mg USING (dataset)""",
)
def _(spark, d):
    plan = X.table(spark, d, "events").groupBy(F.col("event_type").alias("dataset")).agg(F.min(F.col("ts").cast("date")).alias("start_date"))
    return W.resume_from(plan, _merged(spark, d), "2024-01-20")
