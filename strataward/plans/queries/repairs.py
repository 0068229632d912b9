"""Detection and repair over faulty bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.functions.size import SkewPolicy
from strataward.operators import repair as R
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

SPLIT = SkewPolicy(mode="blocks", block_rows=64)
NUMBERS = ("open", "high", "low", "close", "volume")
COLUMNS = ("ts_code", "trade_date", *NUMBERS)


def _sev(high, medium):
    return f"CASE WHEN p > {high} THEN 'high' WHEN p > {medium} THEN 'medium' ELSE 'low' END"


def _fault(issue, field, n, frm, severity, lower="CAST(NULL AS DOUBLE)", upper="CAST(NULL AS DOUBLE)", total="count(*)"):
    name = f"'{field}'" if field else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{issue}' AS issue, {name} AS field, n AS "count", round(p, 6) AS percentage, {severity} AS severity,
      lower, upper FROM (SELECT n, n * 100.0::DOUBLE / t AS p, lower, upper FROM
      (SELECT CAST({n} AS BIGINT) AS n, {total} AS t, {lower} AS lower, {upper} AS upper FROM {frm})) WHERE n > 0"""


def _views(name="f", src="SELECT * FROM bars_faulty", more=""):
    return X.with_views("bars_faulty", extra=f"{name} AS ({src}){more}")


_F = _views()
NULLS = "\nUNION ALL ".join(
    _fault("nulls", c, f"count(*) - count({c})", "f", _sev(10, 1)) for c in COLUMNS
)
_BOUNDS = ", b AS (SELECT " + ", ".join(
    f"quantile_cont({c}::DOUBLE, 0.25) - 1.5 * (quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25)) AS {c}_lo, "
    f"quantile_cont({c}::DOUBLE, 0.75) + 1.5 * (quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25)) AS {c}_hi"
    for c in NUMBERS
) + " FROM f)"
OUTLIERS = "\nUNION ALL ".join(
    _fault("outliers", c, f"count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi)", "f, b", _sev(5, 1), f"round(any_value({c}_lo), 6)",
           f"round(any_value({c}_hi), 6)")
    for c in NUMBERS
)
DUPES = _fault("duplicates", None, "sum(k - 1)", f"(SELECT count(*) AS k FROM f GROUP BY {', '.join(COLUMNS)})", _sev(5, 1), total="sum(k)")
OHLC = _fault(
    "ohlc_inconsistency", None,
    "count(*) FILTER (open IS NOT NULL AND close IS NOT NULL AND (high < greatest(open, close) OR low > least(open, close)))", "f",
    "CASE WHEN p > 2 THEN 'high' ELSE 'medium' END",
)
GAPS = _fault(
    "date_gaps", "trade_date", "count(*) FILTER (step > 3)",
    """(SELECT date_diff('day', lag(d) OVER (PARTITION BY ts_code ORDER BY d), d) AS step
     FROM (SELECT DISTINCT ts_code, CAST(strptime(trade_date, '%Y%m%d') AS DATE) AS d FROM f))""",
    "CASE WHEN n > 5 THEN 'medium' ELSE 'low' END",
)
_FAULTS = "\nUNION ALL ".join([NULLS, DUPES, OUTLIERS, OHLC, GAPS])
CONFIG = R.RepairConfig(max_gap_days=3)


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("percentage", "lower", "upper")})


@query("detect_nulls", _F + NULLS)
def _(spark, d):
    return _rounded(R.detect_nulls(X.bars_faulty(spark, d)))


@query("detect_outliers", _views(more=_BOUNDS) + OUTLIERS)
def _(spark, d):
    return _rounded(R.detect_outliers(X.bars_faulty(spark, d)))


@query("detect_outliers_split", _views(more=_BOUNDS) + OUTLIERS)
def _(spark, d):
    return _rounded(R.detect_outliers(X.bars_faulty(spark, d), policy=SPLIT))


@query("detect_duplicates", _F + DUPES)
def _(spark, d):
    return _rounded(R.detect_duplicates(X.bars_faulty(spark, d)))


@query("detect_ohlc", _F + OHLC)
def _(spark, d):
    return _rounded(R.detect_ohlc(X.bars_faulty(spark, d)))


@query("detect_date_gaps", _F + GAPS)
def _(spark, d):
    return _rounded(R.detect_date_gaps(X.bars_faulty(spark, d), "trade_date", ["ts_code"], 3))


@query("detect_faults", _views(more=_BOUNDS) + _FAULTS)
def _(spark, d):
    return _rounded(R.detect_faults(X.bars_faulty(spark, d), "trade_date", ["ts_code"], CONFIG))


_TICK_HOLES = X.with_views("ticks", extra="f AS (SELECT code, ts, seq, CASE WHEN seq % 4 <> 1 THEN value END AS value, CASE WHEN seq % 9 <> 2 THEN volume END AS volume FROM ticks)")
FFILL = _TICK_HOLES + """SELECT code, ts, seq, last_value(value IGNORE NULLS) OVER w AS value, last_value(volume IGNORE NULLS) OVER w AS volume
 FROM f WINDOW w AS (PARTITION BY code ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _tick_holes(spark, d):
    return X.ticks(spark, d).withColumns(
        {"value": F.when(F.col("seq") % 4 != 1, F.col("value")), "volume": F.when(F.col("seq") % 9 != 2, F.col("volume"))}
    )


@query("repair_ffill", FFILL)
def _(spark, d):
    return R.repair_ffill(_tick_holes(spark, d), ["value", "volume"], ["ts", "seq"], ["code"])


@query("repair_ffill_split", FFILL)
def _(spark, d):
    return R.repair_ffill(_tick_holes(spark, d), ["value", "volume"], ["ts", "seq"], ["code"], SPLIT)


def _clip(c):
    return f"round(CASE WHEN {c} IS NOT NULL THEN least(greatest({c}::DOUBLE, {c}_lo), {c}_hi) END, 6) AS {c}"


@query("repair_winsorize", _views(more=_BOUNDS) + f"SELECT ts_code, trade_date, {', '.join(_clip(c) for c in NUMBERS)} FROM f, b")
def _(spark, d):
    bars = X.bars_faulty(spark, d)
    out = R.repair_winsorize(bars, R.outlier_bounds(bars))
    return out.withColumns({c: F.round(c, 6) for c in NUMBERS})


@query("repair_dedup", _F + f"SELECT DISTINCT {', '.join(COLUMNS)} FROM f")
def _(spark, d):
    return R.repair_dedup(X.bars_faulty(spark, d))


@query(
    "repair_ohlc",
    _F + "SELECT ts_code, trade_date, open, greatest(high, open, close) AS high, least(low, open, close) AS low, close, volume FROM f",
)
def _(spark, d):
    return R.repair_ohlc(X.bars_faulty(spark, d))


GAP_FILL = X.with_views("bars", "calendar", extra="""
s AS (SELECT ts_code, CAST(strptime(trade_date, '%Y%m%d') AS DATE) AS d, close, volume FROM bars),
p AS (SELECT *, lag(d) OVER w AS pd, lag(close) OVER w AS pc, lag(volume) OVER w AS pv FROM s WINDOW w AS (PARTITION BY ts_code ORDER BY d)),
x AS (SELECT ts_code, d, close, volume, pd, pc, pv, CAST(unnest(generate_series(coalesce(pd + 1, d)::TIMESTAMP, d::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM p)
""") + """SELECT ts_code, strftime(day, '%Y%m%d') AS trade_date,
 round(CASE WHEN day = d THEN close ELSE pc + (close - pc) * date_diff('day', pd, day)::DOUBLE / date_diff('day', pd, d) END, 6) AS close,
 round(CASE WHEN day = d THEN volume ELSE pv + (volume - pv) * date_diff('day', pd, day)::DOUBLE / date_diff('day', pd, d) END, 6) AS volume,
 day <> d AS is_filled FROM x"""


def _gap_source(spark, d):
    return X.bars(spark, d).select("ts_code", "trade_date", "close", F.col("volume").cast("double").alias("volume"))


def _gap_round(df):
    return df.withColumns({"close": F.round("close", 6), "volume": F.round("volume", 6)})


@query("repair_gaps", GAP_FILL)
def _(spark, d):
    return _gap_round(R.repair_gaps(_gap_source(spark, d), "trade_date", ["close", "volume"], ["ts_code"]))


@query("repair_gaps_split", GAP_FILL)
def _(spark, d):
    return _gap_round(R.repair_gaps(_gap_source(spark, d), "trade_date", ["close", "volume"], ["ts_code"], policy=SPLIT))


@query(
    "repair_gaps_undated",
    X.with_views("bars") + """SELECT ts_code, CASE WHEN volume % 5 = 0 THEN 'n/a' ELSE trade_date END AS trade_date, close, CAST(volume AS DOUBLE) AS volume FROM bars""",
)
def _(spark, d):
    # a fifth of the rows have no readable date; they and all others stay
    lost = F.col("volume") % 5 == 0
    source = _gap_source(spark, d).withColumn("trade_date", F.when(lost, "n/a").otherwise(F.col("trade_date")))
    return R.repair_gaps(source, "trade_date", ["close", "volume"], ["ts_code"]).where("NOT is_filled").drop("is_filled")


@query("repair_gaps_calendar", GAP_FILL + " JOIN calendar ON cal_date = day WHERE day = d OR is_open = 1")
def _(spark, d):
    source = _gap_source(spark, d)
    return _gap_round(R.repair_gaps(source, "trade_date", ["close", "volume"], ["ts_code"], X.calendar(spark, d)))


@query(
    "repair_confidence",
    _views(more=_BOUNDS) + f"""SELECT count(*) AS faults, count(*) AS repaired, round(avg(CASE issue WHEN 'nulls' THEN 1 - percentage / 100
 WHEN 'outliers' THEN 1 - percentage / 200 WHEN 'duplicates' THEN 0.95 WHEN 'ohlc_inconsistency' THEN 0.8 ELSE 0.6 END), 4) AS confidence
 FROM ({_FAULTS})""",
)
def _(spark, d):
    faults = R.detect_faults(X.bars_faulty(spark, d), "trade_date", ["ts_code"], CONFIG)
    return R.repair_confidence(faults).withColumn("confidence", F.round("confidence", 4))


_CHAIN = _views(more=_BOUNDS + """,
r1 AS (SELECT ts_code, trade_date, """ + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in NUMBERS) + """ FROM f
  WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r2 AS (SELECT DISTINCT ts_code, CAST(strptime(trade_date, '%Y%m%d') AS DATE) AS d, """ + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}::DOUBLE, {c}_lo), {c}_hi) END AS {c}" for c in NUMBERS) + """ FROM r1, b),
r3 AS (SELECT ts_code, d, open, greatest(high, open, close) AS high, least(low, open, close) AS low, close, volume FROM r2),
p AS (SELECT *, lag(d) OVER w AS pd, """ + ", ".join(f"lag({c}) OVER w AS p_{c}" for c in NUMBERS) + """ FROM r3 WINDOW w AS (PARTITION BY ts_code ORDER BY d)),
x AS (SELECT *, CAST(unnest(generate_series(coalesce(pd + 1, d)::TIMESTAMP, d::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM p)""")


@query(
    "repair_dataset",
    _CHAIN + "SELECT ts_code, strftime(day, '%Y%m%d') AS trade_date, " + ", ".join(
        f"round(CASE WHEN day = d THEN {c} ELSE p_{c} + ({c} - p_{c}) * (date_diff('day', pd, day)::DOUBLE / date_diff('day', pd, d)) END, 9) AS {c}"
        for c in NUMBERS) + ", day <> d AS is_filled FROM x",
)
def _(spark, d):
    out, _faults = R.repair_dataset(X.bars_faulty(spark, d), ["trade_date"], ["ts_code"], "trade_date", config=CONFIG)
    return out.withColumns({c: F.round(c, 9) for c in NUMBERS})
