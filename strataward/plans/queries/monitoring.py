"""Scores, reports, metrics, trends and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.functions.size import SkewPolicy
from strataward.operators import ledger as G
from strataward.operators import monitor as M
from strataward.operators import score as S
from strataward.operators.issues import issue_columns
from strataward.operators.suppression import suppress_alerts
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry
from strataward.session import scratch_path

REGISTRY = Registry()
query = REGISTRY.query

TS = "2024-01-31 00:00:00"

# one issue per order line that breaks a rule; the check name depends on the line
_CHECKS = ("required_field_null", "price_bounds", "price_anomaly", "missing_stock_code", "ohlc_high", "invalid_reference", "date_format", "revision")
_SCOPES = ("field", "field", "anomaly", "cross", "logical", "referential", "field", "cross")
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_ISSUES = f"""iss AS (SELECT l_returnflag AS dataset, {_LIST(_SCOPES)}[(l_orderkey % 8 + 1)::INT] AS scope, {_LIST(_CHECKS)}[(l_orderkey % 8 + 1)::INT] AS chk,
   CAST(sum(l_quantity) AS BIGINT) AS cnt FROM lineitem GROUP BY l_returnflag, l_orderkey),
tot AS (SELECT l_returnflag AS dataset, count(*) AS total_records FROM lineitem GROUP BY 1
  UNION ALL SELECT 'empty', CAST(0 AS BIGINT)),
sc AS (SELECT t.dataset, t.total_records, coalesce(i.n, 0) AS total_issues, CASE WHEN t.total_records > 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - coalesce(i.n, 0)::DOUBLE / t.total_records))
   WHEN coalesce(i.n, 0) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS quality_score FROM tot t LEFT JOIN (SELECT dataset, count(*) AS n FROM iss GROUP BY 1) i USING (dataset)),
sev AS (SELECT *, CASE WHEN regexp_matches(chk, 'missing|null|required|invalid') THEN 'critical' WHEN regexp_matches(chk, 'anomaly|inconsistency|revision') THEN 'high'
   WHEN regexp_matches(chk, 'bounds|range|format') THEN 'medium' ELSE 'low' END AS severity FROM iss)"""


def _issues(spark, d):
    li = X.table(spark, d, "lineitem").groupBy("l_returnflag", "l_orderkey").agg(F.sum("l_quantity").alias("l_quantity"))
    at = (F.col("l_orderkey") % 8 + 1).cast("int")
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), at)
    return li.select(*issue_columns(F.col("l_returnflag"), pick(_SCOPES), pick(_CHECKS), "l_quantity", F.col("l_orderkey"), count=F.col("l_quantity")))


def _totals(spark, d):
    per = X.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("dataset")).agg(F.count(F.lit(1)).alias("total_records"))
    return per.unionByName(spark.createDataFrame([("empty", 0)], "dataset string, total_records long"))


@query("quality_score", f"WITH {_ISSUES} SELECT dataset, total_records, total_issues, round(quality_score, 6) AS quality_score FROM sc")
def _(spark, d):
    return S.dataset_scores(_issues(spark, d), _totals(spark, d)).withColumn("quality_score", F.round("quality_score", 6))


@query("issue_severity", f'WITH {_ISSUES} SELECT dataset, chk AS "check", severity, count(*) AS n FROM sev GROUP BY ALL')
def _(spark, d):
    tagged = _issues(spark, d).withColumn("severity", S.issue_severity("check"))
    return tagged.groupBy("dataset", "check", "severity").agg(F.count(F.lit(1)).alias("n"))


_SUMMARY = """SELECT dataset, count(*) AS total_issues, count(*) FILTER (severity = 'critical') AS critical_issues, count(*) FILTER (severity = 'high') AS high_issues,
 count(*) FILTER (severity = 'medium') AS medium_issues, count(*) FILTER (severity = 'low') AS low_issues, string_agg(DISTINCT scope, ',' ORDER BY scope) AS validation_types
 FROM sev GROUP BY dataset"""


@query("issue_summary", f"WITH {_ISSUES} {_SUMMARY}")
def _(spark, d):
    return S.issue_summary(_issues(spark, d))


_REPORT = f"""WITH {_ISSUES}, su AS ({_SUMMARY}) SELECT sc.dataset, '{TS}' AS generated_at, total_records, sc.total_issues, round(quality_score, 6) AS quality_score,
 coalesce(critical_issues, 0) AS critical_issues, coalesce(high_issues, 0) AS high_issues, coalesce(medium_issues, 0) AS medium_issues, coalesce(low_issues, 0) AS low_issues
 FROM sc LEFT JOIN su ON sc.dataset = su.dataset"""
_REPORT_TYPE = (
    "generated_at string, dataset string, total_records long, total_issues long, quality_score double, "
    "critical_issues long, high_issues long, medium_issues long, low_issues long"
)


@query("report_rows", _REPORT)
def _(spark, d):
    rows = S.report_rows(_issues(spark, d), _totals(spark, d), TS)
    return rows.select(F.from_json("report", _REPORT_TYPE).alias("r")).select("r.*")


@query("write_report", _REPORT)
def _(spark, d):
    path = scratch_path(spark, "report")
    S.write_report(_issues(spark, d), _totals(spark, d), TS, path)
    return spark.read.schema(_REPORT_TYPE).json(f"{path}/summary")


_METRICS = f""", mx AS (SELECT dataset, count(*) AS total_issues, coalesce(sum(cnt) FILTER (chk LIKE '%anomaly%'), 0)::BIGINT AS anomaly_count,
  count(*) FILTER (scope = 'logical') AS consistency_issues, count(*) FILTER (scope = 'referential') AS integrity_issues,
  coalesce(sum(cnt) FILTER (chk LIKE '%null%'), 0)::BIGINT AS null_count, coalesce(sum(cnt) FILTER (chk LIKE '%bounds%'), 0)::BIGINT AS bounds_violations FROM iss GROUP BY 1),
me AS (SELECT sc.dataset, TIMESTAMP '{TS}' AS ts, quality_score, sc.total_issues, coalesce(anomaly_count, 0) AS anomaly_count, coalesce(consistency_issues, 0) AS consistency_issues,
  coalesce(integrity_issues, 0) AS integrity_issues, total_records, coalesce(null_count, 0) AS null_count, coalesce(bounds_violations, 0) AS bounds_violations
  FROM sc LEFT JOIN mx ON sc.dataset = mx.dataset)"""


@query("extract_metrics", f"WITH {_ISSUES}{_METRICS} SELECT * REPLACE (round(quality_score, 6) AS quality_score) FROM me")
def _(spark, d):
    return M.extract_metrics(_issues(spark, d), _totals(spark, d), TS).withColumn("quality_score", F.round("quality_score", 6))


def _rule(name, severity, value, limit, op, side):
    return f"""SELECT substr(sha256('{name}|' || dataset || '|{severity}|' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 16) AS alert_id, '{name}' AS alert_type,
      '{severity}' AS severity, dataset, '{name}' AS metric, round({value}, 6) AS value, {limit}::DOUBLE AS threshold,
      '{name} of ' || dataset || ' is {side} its threshold {limit:g}' AS message, ts FROM me WHERE {value} {op} {limit}"""


@query(
    "threshold_alerts",
    f"WITH {_ISSUES}{_METRICS} " + " UNION ALL ".join([
        _rule("quality_score", "high", "quality_score::DOUBLE", 0.85, "<", "below"),
        _rule("anomaly_rate", "medium", "coalesce(anomaly_count::DOUBLE / nullif(total_records, 0), 0)", 0.05, ">", "above"),
        _rule("consistency_issues", "medium", "consistency_issues::DOUBLE", 10, ">", "above"),
        _rule("integrity_issues", "high", "integrity_issues::DOUBLE", 5, ">", "above"),
    ]),
)
def _(spark, d):
    metrics = M.extract_metrics(_issues(spark, d), _totals(spark, d), TS)
    return M.threshold_alerts(metrics, M.Thresholds(quality_score=0.85)).withColumn("value", F.round("value", 6))


_HIST = X.with_views("metrics_hist")


def _trend(change):
    return f"CASE WHEN n < 2 THEN 'insufficient_data' WHEN {change} > 0.01 THEN 'improving' WHEN {change} < -0.01 THEN 'degrading' ELSE 'stable' END"


def _trends_sql(value, sign):
    one = lambda name, group: f"""SELECT {name} AS dataset, count(*) AS n, arg_min(v, (ts, dataset)) AS f, arg_max(v, (ts, dataset)) AS l, avg(v) AS a FROM w {group}"""
    return _HIST.rstrip() + f""", w AS (SELECT dataset, ts, {value}::DOUBLE AS v FROM metrics_hist WHERE ts >= TIMESTAMP '{TS}' - INTERVAL 14 DAY),
    t AS ({one("dataset", "GROUP BY dataset")} UNION ALL {one("'*'", "")})
    SELECT dataset, n AS points, round(f, 6) AS first_value, round(l, 6) AS last_value, round(a, 6) AS average_value, round(l - f, 6) AS change, {_trend(f"{sign}(l - f)")} AS trend FROM t"""


def _trends_rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("first_value", "last_value", "average_value", "change")})


@query("quality_trends", _trends_sql("quality_score", ""))
def _(spark, d):
    return _trends_rounded(M.quality_trends(X.metrics_hist(spark, d), TS, 14))


@query("issue_trends", _trends_sql("total_issues", "-"))
def _(spark, d):
    return _trends_rounded(M.quality_trends(X.metrics_hist(spark, d), TS, 14, "total_issues", higher_is_better=False))


@query(
    "dataset_summary",
    _HIST + f"""SELECT dataset, latest_ts, round(l, 6) AS latest_score, latest_issues, latest_records, round(a, 6) AS average_score, max_issues, min_issues, total_records,
    {_trend("(l - f)")} AS trend FROM (SELECT dataset, count(*) AS n, max(ts) AS latest_ts, arg_min(quality_score, ts) AS f, arg_max(quality_score, ts) AS l,
    arg_max(total_issues, ts) AS latest_issues, arg_max(total_records, ts) AS latest_records, avg(quality_score) AS a, max(total_issues) AS max_issues,
    min(total_issues) AS min_issues, CAST(sum(total_records) AS BIGINT) AS total_records FROM metrics_hist GROUP BY dataset)""",
)
def _(spark, d):
    return M.dataset_summary(X.metrics_hist(spark, d)).withColumns({c: F.round(c, 6) for c in ("latest_score", "average_score")})


@query(
    "apply_retention",
    _HIST + f"SELECT dataset, ts, round(quality_score, 6) AS quality_score, total_issues, total_records FROM metrics_hist WHERE ts >= TIMESTAMP '{TS}' - INTERVAL 10 DAY",
)
def _(spark, d):
    return M.apply_retention(X.metrics_hist(spark, d), TS, 10).withColumn("quality_score", F.round("quality_score", 6))


_FEED = X.with_views("alert_feed")


@query("active_alerts", _FEED + "SELECT * FROM alert_feed WHERE severity = 'high' AND CAST(substr(alert_id, 2) AS BIGINT) % 3 <> 0")
def _(spark, d):
    feed = X.alert_feed(spark, d)
    seen = feed.where(F.substring("alert_id", 2, 20).cast("long") % 3 == 0).select("alert_id")
    return M.active_alerts(feed, severity="high", acknowledged=seen)


@query("clear_alerts", _FEED + "SELECT * FROM alert_feed WHERE dataset <> '7'")
def _(spark, d):
    return M.clear_alerts(X.alert_feed(spark, d), "7")


@query(
    "alert_summary",
    _FEED.rstrip() + """, g AS (SELECT 'all' AS "grouping", '*' AS value, * FROM alert_feed UNION ALL SELECT 'severity', severity, * FROM alert_feed UNION ALL SELECT 'dataset', dataset, * FROM alert_feed)
    SELECT "grouping", value, count(*) AS alerts, max(ts) AS most_recent, arg_max(alert_id, ts) AS most_recent_id FROM g GROUP BY 1, 2""",
)
def _(spark, d):
    return M.alert_summary(X.alert_feed(spark, d))


def _chain(minutes: int, name: str = "alert_feed", where: str = "") -> str:
    """Emitted alerts: the first of a key, then the first one a window later, and so on."""
    return X.with_views("alert_feed", recursive=True, extra=f"""fd AS (SELECT * FROM {name} {where}),
 fo AS (SELECT *, alert_type || '|' || dataset || '|' || severity AS k FROM fd),
 nx AS (SELECT k, ts, min(ts) OVER (PARTITION BY k ORDER BY ts RANGE BETWEEN INTERVAL {minutes} MINUTE FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM fo),
 ch(k, ts) AS (SELECT k, min(ts) FROM fo GROUP BY k UNION ALL SELECT nx.k, nx.nt FROM ch JOIN nx ON ch.k = nx.k AND ch.ts = nx.ts WHERE nx.nt IS NOT NULL)""")


_EMITTED = "SELECT alert_id, alert_type, dataset, severity, ts FROM fo WHERE (k, ts) IN (SELECT (k, ts) FROM ch)"


@query("suppress_alerts", _chain(30) + _EMITTED)
def _(spark, d):
    return suppress_alerts(X.alert_feed(spark, d))


_BROAD = _chain(720).replace("alert_type || '|' || dataset || '|' || severity", "severity")


@query("suppress_alerts_broad", _BROAD + _EMITTED)
def _(spark, d):
    # two keys that hold all alerts, with half a day of memory
    return suppress_alerts(X.alert_feed(spark, d), ["severity"], 720)


@query("suppress_alerts_split", _BROAD + _EMITTED)
def _(spark, d):
    return suppress_alerts(X.alert_feed(spark, d), ["severity"], 720, policy=SkewPolicy(mode="blocks"))


@query("suppress_alerts_muted", _chain(30, where="WHERE dataset <> '7'") + _EMITTED)
def _(spark, d):
    return suppress_alerts(X.alert_feed(spark, d), muted=[("error", "7")])


def _in_two(spark, frame, write):
    """Give rows to ``write`` in two loads, the first ones twice."""
    early = F.col("ts") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    for part in (frame.where(early), frame.where(early), frame.where(~early)):
        write(part)


@query("record_metrics", X.with_views("metrics_hist") + "SELECT dataset, ts, round(quality_score, 6) AS quality_score, total_issues, total_records FROM metrics_hist")
def _(spark, d):
    path = scratch_path(spark, "metrics")
    _in_two(spark, X.metrics_hist(spark, d), lambda part: G.record_metrics(part, path))
    return G.load_rows(spark, path).withColumn("quality_score", F.round("quality_score", 6))


@query(
    "trim_metrics",
    X.with_views("metrics_hist") + "SELECT dataset, ts, total_issues, total_records FROM metrics_hist WHERE ts >= TIMESTAMP '2024-01-20'",
)
def _(spark, d):
    path = scratch_path(spark, "metrics")
    G.record_metrics(X.metrics_hist(spark, d), path)
    G.trim_rows(spark, path, "2024-01-20")
    return G.load_rows(spark, path).drop("quality_score")


_RAISED = _chain(30) + "SELECT alert_id, alert_type, dataset, severity, ts, {flag} AS acknowledged FROM fo WHERE (k, ts) IN (SELECT (k, ts) FROM ch)"


def _raised(spark, d):
    path = scratch_path(spark, "alerts")
    _in_two(spark, X.alert_feed(spark, d), lambda part: G.raise_alerts(part, path))
    return path


@query("raise_alerts", _RAISED.format(flag="false"))
def _(spark, d):
    return G.load_rows(spark, _raised(spark, d))


_K = "alert_type || '|' || dataset || '|' || severity"
_LATE = X.with_views("alert_feed", recursive=True, extra=f"""al AS (SELECT *, {_K} AS k, CAST(substr(alert_id, 2) AS BIGINT) % 2 = 0 AS even FROM alert_feed),
 nx AS (SELECT k, ts, min(ts) OVER (PARTITION BY k ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM al WHERE even),
 fa(k, ts) AS (SELECT k, min(ts) FROM al WHERE even GROUP BY k UNION ALL SELECT nx.k, nx.nt FROM fa JOIN nx ON fa.k = nx.k AND fa.ts = nx.ts WHERE nx.nt IS NOT NULL),
 od AS (SELECT al.*, coalesce((SELECT max(fa.ts) FROM fa WHERE fa.k = al.k AND fa.ts <= al.ts), TIMESTAMP '1900-01-01') AS seed FROM al WHERE NOT even),
 ox AS (SELECT k, seed, ts, min(ts) OVER (PARTITION BY k, seed ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM od),
 oc(k, seed, ts) AS (SELECT k, seed, min(ts) FROM od WHERE ts >= seed + INTERVAL 30 MINUTE GROUP BY k, seed
  UNION ALL SELECT ox.k, ox.seed, ox.nt FROM oc JOIN ox ON oc.k = ox.k AND oc.seed = ox.seed AND oc.ts = ox.ts WHERE ox.nt IS NOT NULL)""") + """
 SELECT alert_id, alert_type, dataset, severity, ts, false AS acknowledged FROM al WHERE even AND (k, ts) IN (SELECT (k, ts) FROM fa)
 UNION ALL SELECT alert_id, alert_type, dataset, severity, ts, false FROM od WHERE (k, seed, ts) IN (SELECT (k, seed, ts) FROM oc)"""


@query("raise_alerts_late", _LATE)
def _(spark, d):
    """Every other alert comes late, in among those that are stored, and then all come once more."""
    path = scratch_path(spark, "late")
    even = F.substring("alert_id", 2, 20).cast("long") % 2 == 0
    feed = X.alert_feed(spark, d)
    for part in (feed.where(even), feed.where(~even), feed):
        G.raise_alerts(part, path)
    return G.load_rows(spark, path)


@query("suppress_alerts_dense", _chain(1, where="WHERE ts < TIMESTAMP '2024-01-08'").replace(_K, "''") + _EMITTED)
def _(spark, d):
    """One key with all alerts and a window of a minute, in blocks of 16 instants."""
    week = X.alert_feed(spark, d).where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    one = week.withColumn("one", F.lit(1))
    return suppress_alerts(one, ["one"], 1, policy=SkewPolicy(mode="blocks", block_rows=16), block_rows=16).drop("one")


@query("acknowledge_alerts", _RAISED.format(flag="CAST(substr(alert_id, 2) AS BIGINT) % 3 = 0"))
def _(spark, d):
    path = _raised(spark, d)
    G.acknowledge_alerts(spark, path, X.alert_feed(spark, d).where(F.substring("alert_id", 2, 20).cast("long") % 3 == 0))
    return G.load_rows(spark, path)
