"""Value anomalies, per user and over the whole frame, in both plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.functions.quantiles import key_quantiles
from strataward.functions.size import SkewPolicy
from strataward.operators import anomaly as A
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

SPLIT = SkewPolicy(mode="blocks", block_rows=64)
# users with more than 60 events are split, the others stay whole
MIXED = SkewPolicy(small_bytes=0, max_group_rows=60, block_rows=60)
CONFIG = A.AnomalyConfig(volatility_threshold=0.5)


def _flags(part: str, order: str, tail: str = "") -> str:
    """Every flag as window SQL over ``src``; part is the PARTITION BY clause."""
    return f"""
a AS (SELECT *, quantile_cont(value, 0.25) OVER ({part}) AS q1, quantile_cont(value, 0.75) OVER ({part}) AS q3,
        avg(value) OVER ({part}) AS m, stddev_samp(value) OVER ({part}) AS s,
        abs(value - lag(value) OVER ({part} ORDER BY {order})) AS delta,
        last_value(value IGNORE NULLS) OVER ({part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held,
        avg(volume) OVER ({part} ORDER BY {order} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS vavg,
        count(volume) OVER ({part} ORDER BY {order} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS vn FROM src),
b AS (SELECT *, held / nullif(lag(held) OVER ({part} ORDER BY {order}), 0) - 1 AS ret,
        avg(delta) OVER ({part}) AS dm, stddev_samp(delta) OVER ({part}) AS ds FROM a),
c AS (SELECT *, stddev_samp(ret) OVER ({part}) AS rs,
        stddev_samp(ret) OVER ({part} ORDER BY {order} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS roll,
        count(ret) OVER ({part} ORDER BY {order} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rn FROM b),
f AS (SELECT *, coalesce(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1), false) AS iqr_anomaly,
        abs((value - m) / nullif(s, 0)) > 3.0 AS zscore_anomaly,
        coalesce(rn = 20 AND roll > rs * 1.5 AND roll > 0, false) AS volatility_anomaly,
        delta > dm + 2.0 * ds AS price_gap_anomaly,
        CASE WHEN vn = 5 THEN volume > vavg END AS volume_confirmed FROM c),
g AS (SELECT *, iqr_anomaly OR zscore_anomaly OR volatility_anomaly OR price_gap_anomaly AS is_anomaly,
        (iqr_anomaly::INT + coalesce(zscore_anomaly, false)::INT + volatility_anomaly::INT
         + coalesce(price_gap_anomaly, false)::INT) / 4.0::DOUBLE AS anomaly_score FROM f)
{tail}"""


_TICKS = "src AS (SELECT * FROM ticks)"
_BY_USER = X.with_views("ticks", extra=_TICKS + "," + _flags("PARTITION BY code", "ts, seq"))
_WHOLE = X.with_views("ticks", extra=_TICKS + "," + _flags("PARTITION BY 1", "ts, seq"))
_HOLES = X.with_views(
    "ticks",
    extra="src AS (SELECT code, ts, seq, CASE WHEN seq % 9 <> 4 THEN value END AS value, volume FROM ticks),"
    + _flags("PARTITION BY code", "ts, seq"),
)
_FULL = """SELECT code, ts, seq, value, volume, iqr_anomaly, zscore_anomaly, volatility_anomaly, price_gap_anomaly,
 volume_confirmed, is_anomaly, CAST(anomaly_score AS DOUBLE) AS anomaly_score FROM g"""


def _holes(spark, d):
    return X.ticks(spark, d).withColumn("value", F.when(F.col("seq") % 9 != 4, F.col("value")))


@query("iqr_anomaly", _BY_USER + "SELECT code, ts, seq, value, volume, iqr_anomaly FROM g")
def _(spark, d):
    return A.iqr_anomaly(X.ticks(spark, d), "value", ["code"])


@query("zscore_anomaly", _BY_USER + "SELECT code, ts, seq, value, volume, zscore_anomaly FROM g")
def _(spark, d):
    return A.zscore_anomaly(X.ticks(spark, d), "value", ["code"])


@query("iqr_anomaly_mixed", _BY_USER + "SELECT code, ts, seq, value, volume, iqr_anomaly FROM g")
def _(spark, d):
    return A.iqr_anomaly(X.ticks(spark, d), "value", ["code"], policy=MIXED)


@query("volatility_anomaly", _BY_USER + "SELECT code, ts, seq, value, volume, volatility_anomaly FROM g")
def _(spark, d):
    return A.volatility_anomaly(X.ticks(spark, d), "value", ["ts", "seq"], ["code"], CONFIG)


@query("price_gap_anomaly", _BY_USER + "SELECT code, ts, seq, value, volume, price_gap_anomaly FROM g")
def _(spark, d):
    return A.price_gap_anomaly(X.ticks(spark, d), "value", ["ts", "seq"], ["code"])


@query("volume_confirmed", _BY_USER + "SELECT code, ts, seq, value, volume, volume_confirmed FROM g")
def _(spark, d):
    return A.volume_confirmed(X.ticks(spark, d), "volume", ["ts", "seq"], ["code"])


@query("detect_anomalies", _HOLES + _FULL)
def _(spark, d):
    return A.detect_anomalies(_holes(spark, d), "value", ["ts", "seq"], ["code"], "volume", CONFIG)


@query("detect_anomalies_split", _HOLES + _FULL)
def _(spark, d):
    return A.detect_anomalies(_holes(spark, d), "value", ["ts", "seq"], ["code"], "volume", CONFIG, SPLIT)


@query("detect_anomalies_mixed", _HOLES + _FULL)
def _(spark, d):
    return A.detect_anomalies(_holes(spark, d), "value", ["ts", "seq"], ["code"], "volume", CONFIG, MIXED)


@query("detect_anomalies_whole_frame", _WHOLE + _FULL)
def _(spark, d):
    return A.detect_anomalies(X.ticks(spark, d), "value", ["ts", "seq"], (), "volume", CONFIG, SPLIT)


@query(
    "anomaly_summary",
    _BY_USER
    + """SELECT code, count(*) AS total_records, count(*) FILTER (is_anomaly) AS anomaly_count,
    round(count(*) FILTER (is_anomaly) * 100.0::DOUBLE / count(*), 6) AS anomaly_pct FROM g GROUP BY code""",
)
def _(spark, d):
    flagged = A.detect_anomalies(X.ticks(spark, d), "value", ["ts", "seq"], ["code"], "volume", CONFIG)
    return A.anomaly_summary(flagged, ["code"]).withColumn("anomaly_pct", F.round("anomaly_pct", 6))


@query("anomaly_samples", _BY_USER + "SELECT code, ts, seq, value, is_anomaly FROM g WHERE is_anomaly ORDER BY ts, seq LIMIT 5")
def _(spark, d):
    flagged = A.detect_anomalies(X.ticks(spark, d), "value", ["ts", "seq"], ["code"], "volume", CONFIG)
    return A.anomaly_samples(flagged, ["ts", "seq"]).select("code", "ts", "seq", "value", "is_anomaly")


_QUANT = """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2,
 round(quantile_cont(value, 0.75), 6) AS q3 FROM events GROUP BY event_type"""


def _quartiles(spark, d, policy):
    e = X.table(spark, d, "events")
    q = key_quantiles(e, ["event_type"], "value", [0.25, 0.5, 0.75], ["q1", "q2", "q3"], policy=policy)
    return q.select("event_type", *[F.round(c, 6).alias(c) for c in ("q1", "q2", "q3")])


@query("key_quantiles", _QUANT)
def _(spark, d):
    return _quartiles(spark, d, SkewPolicy())


_ENDLESS = """SELECT event_type, CAST(quantile_disc(v, 0.5) AS VARCHAR) AS q2, CAST(quantile_disc(v, 0.9) AS VARCHAR) AS q9, CAST(quantile_disc(v, 0.1) AS VARCHAR) AS q1
 FROM (SELECT event_type, CASE WHEN event_id % 4 = 0 THEN 'infinity'::DOUBLE WHEN event_id % 4 = 1 THEN '-infinity'::DOUBLE ELSE round(value) END AS v FROM events) GROUP BY event_type"""


def _endless(spark, d, policy):
    kind = F.col("event_id") % 4
    v = F.when(kind == 0, F.lit(float("inf"))).when(kind == 1, F.lit(float("-inf"))).otherwise(F.round("value"))
    e = X.table(spark, d, "events").select("event_type", v.alias("v"))
    q = key_quantiles(e, ["event_type"], "v", [0.1, 0.5, 0.9], ["q1", "q2", "q9"], "disc", policy)
    text = lambda c: F.when(F.col(c) == float("inf"), "inf").when(F.col(c) == float("-inf"), "-inf").otherwise(F.col(c).cast("string"))
    return q.select("event_type", *[text(c).alias(c) for c in ("q1", "q2", "q9")])


@query(
    "key_quantiles_epoch",
    """SELECT event_type, quantile_disc(s, 0.1) AS q1, quantile_disc(s, 0.5) AS q2, quantile_disc(s, 0.9) AS q9, 7.5::DOUBLE AS c1
    FROM (SELECT event_type, CAST(epoch(ts) AS DOUBLE) AS s FROM events) GROUP BY event_type""",
)
def _(spark, d):
    """Seconds since the epoch share their first bits, and a constant column all of them."""
    e = X.table(spark, d, "events").select("event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.lit(7.5).alias("c"))
    e = e.withColumn("s", F.col("us") / 1e6)
    tight = SkewPolicy(mode="blocks", block_rows=16)
    q = key_quantiles(e, ["event_type"], "s", [0.1, 0.5, 0.9], ["q1", "q2", "q9"], "disc", tight)
    return q.join(key_quantiles(e, ["event_type"], "c", [0.5], ["c1"], "disc", tight), "event_type")


@query("key_quantiles_endless", _ENDLESS)
def _(spark, d):
    return _endless(spark, d, SkewPolicy())


@query("key_quantiles_endless_split", _ENDLESS)
def _(spark, d):
    return _endless(spark, d, SPLIT)


@query("key_quantiles_split", _QUANT)
def _(spark, d):
    return _quartiles(spark, d, SPLIT)


@query(
    "key_quantiles_mixed",
    """SELECT user_id, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3
    FROM events GROUP BY user_id""",
)
def _(spark, d):
    q = key_quantiles(X.table(spark, d, "events"), ["user_id"], "value", [0.25, 0.75], ["q1", "q3"], policy=MIXED)
    return q.select("user_id", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"))


@query(
    "key_quantiles_disc",
    "SELECT event_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events GROUP BY event_type",
)
def _(spark, d):
    return key_quantiles(X.table(spark, d, "events"), ["event_type"], "value", [0.25, 0.75], ["q1", "q3"], "disc", SPLIT)


_FLAGSHIP = X.with_views(
    "bars", extra="src AS (SELECT ts_code AS code, trade_date AS ts, 0 AS seq, close AS value, volume FROM bars),"
    + _flags("PARTITION BY code", "ts"),
)


@query(
    "flagship",
    _FLAGSHIP
    + """, ids AS (SELECT code, 999999 + row_number() OVER (ORDER BY code) AS ts_code_id FROM (SELECT DISTINCT code FROM src))
    SELECT ts_code_id, count(*) AS bars, count(*) FILTER (is_anomaly) AS anomalies,
    round(avg(anomaly_score), 6) AS mean_score FROM g JOIN ids USING (code) GROUP BY ts_code_id""",
)
def _(spark, d):
    return flagship(spark, d)


def flagship(spark, d):
    """Daily bars, encoded, flagged and rolled up per code."""
    from strataward.operators.dictionary import allocate_ids, empty_dictionary, encode
    from strataward.operators.normalize import normalize
    from strataward.sources.catalog import dataset

    bars = normalize(X.bars(spark, d), dataset("daily"))
    codes = allocate_ids(empty_dictionary(spark), X.table(spark, d, "events").select(X.code_of(F.col("user_id")).alias("code")), "stock")
    coded = encode(bars, codes, "ts_code")
    flagged = A.detect_anomalies(coded, "close", ["trade_date_int"], ["ts_code_id"], "volume", CONFIG)
    return flagged.groupBy("ts_code_id").agg(
        F.count(F.lit(1)).alias("bars"),
        F.sum(F.coalesce(F.col("is_anomaly"), F.lit(False)).cast("long")).alias("anomalies"),
        F.round(F.avg("anomaly_score"), 6).alias("mean_score"),
    )
