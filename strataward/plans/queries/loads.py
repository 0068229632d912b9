"""Whole loads, validation flows and the streaming forms."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataward.operators.dictionary import allocate_ids, empty_dictionary
from strataward.operators.repair import RepairConfig, repair_dataset
from strataward.operators.watermark import load_watermarks
from strataward.plans import fixtures as X
from strataward.plans import flow, load
from strataward.plans.queries import anomalies, consistency, cross
from strataward.plans.queries.monitoring import _EMITTED, _chain
from strataward.plans.queries.storage import YEARLY
from strataward.plans.registry import Registry
from strataward.session import scratch_path
from strataward.sources.catalog import YEAR_MONTH, DatasetSpec
from strataward.sources.reader import source_frame
from strataward.streaming.alerts import STATE_STORE, suppress_stream
from strataward.streaming.ingest import stream_ingest

REGISTRY = Registry()
query = REGISTRY.query

BARS = DatasetSpec("bars", "bars", YEAR_MONTH, "trade_date", ("ts_code_id", "trade_date_int"), keys=("ts_code", "trade_date"))
_IDS = "ids AS (SELECT ts_code, 999999 + row_number() OVER (ORDER BY ts_code) AS ts_code_id FROM (SELECT DISTINCT ts_code FROM bars))"
_LOADED = X.with_views("bars", extra=_IDS + """, loaded AS (SELECT bars.*, CAST(trade_date AS INT) AS trade_date_int,
  CAST(substr(trade_date, 1, 6) AS INT) AS year_month, ts_code_id FROM bars JOIN ids USING (ts_code))""")


def _dictionary(spark, d):
    codes = X.table(spark, d, "events").select(X.code_of(F.col("user_id")).alias("code"))
    return allocate_ids(empty_dictionary(spark), codes, "stock")


@query("run_load", _LOADED + "SELECT * FROM loaded")
def _(spark, d):
    # the second load repeats half of the first and changes nothing
    spec = BARS.located(scratch_path(spark, "load"))
    bars = X.bars(spark, d)
    load.run_load(spark, spec, bars.where(F.col("trade_date") < "20240120"), _dictionary(spark, d), keys=spec.keys)
    load.run_load(spark, spec, bars.where(F.col("trade_date") > "20240110"), _dictionary(spark, d), keys=spec.keys)
    return spark.read.parquet(spec.path)


@query(
    "run_load_order",
    """SELECT o_custkey AS ts_code, strftime(o_orderdate, '%Y%m') || '01' AS trade_date, o_orderkey, o_totalprice AS close,
      CAST(strftime(o_orderdate, '%Y%m') || '01' AS INT) AS trade_date_int, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS year_month
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey DESC) = 1""",
)
def _(spark, d):
    # a customer's orders of a month share a key; the newest order stays, whichever load brings it
    spec = DatasetSpec("monthly", scratch_path(spark, "order"), YEAR_MONTH, "trade_date", ("ts_code", "trade_date_int"))
    rows = X.table(spark, d, "orders").select(
        F.col("o_custkey").alias("ts_code"), F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01")).alias("trade_date"), "o_orderkey",
        F.col("o_totalprice").alias("close"),
    )
    for part in (F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 3 == 0):
        load.run_load(spark, spec, rows.where(part), keys=("ts_code", "trade_date"), order=("o_orderkey",))
    return spark.read.parquet(spec.path)


@query("plan_and_load", _LOADED + "SELECT * FROM loaded")
def _(spark, d):
    # the lake holds ten days of half the codes; the plan brings in the rest of the month
    spec = BARS.located(scratch_path(spark, "incremental"))
    bars, codes = X.bars(spark, d), _dictionary(spark, d)
    some = bars.where((F.col("trade_date") <= "20240110") & (F.substring("ts_code", 7, 1).cast("int") % 2 == 0))
    load.run_load(spark, spec, some, codes, mode="overwrite")
    load.plan_and_load(spark, spec, bars, codes.select("code"), "2024-01-01", "2024-01-31", spec.keys, codes, "full")
    return spark.read.parquet(spec.path)


_PRICED = consistency._ALL.rstrip() + ", src AS (SELECT ts_code AS code, trade_date AS ts, open AS seq, close AS value, volume FROM checked)," + anomalies._flags(
    "PARTITION BY code", "ts NULLS FIRST, seq"
).replace("roll > rs * 1.5", "roll > rs * 3.0")
_ANOMALY = """SELECT 'bars' AS dataset, 'anomaly' AS scope, 'price_anomaly' AS "check", 'close' AS field, CAST(NULL AS VARCHAR) AS entity,
  CAST(NULL AS VARCHAR) AS period, n AS "count", CAST(n AS VARCHAR) || ' anomalous values of close' AS description
  FROM (SELECT count(*) FILTER (is_anomaly) AS n FROM g) WHERE n > 0"""


@query("validate_dataset", _PRICED + consistency._union(consistency._ALL_RULES, _ANOMALY))
def _(spark, d):
    config = flow.FlowConfig(consistency=consistency.CONFIG)
    bars = consistency._checked(spark, d)
    return flow.validate_dataset(bars, "bars", "stock", consistency.AS_OF, ["trade_date", "open"], ["ts_code"], config)


_R = consistency.rule_sql


def _plain_rules(name: str) -> str:
    """Checks of a dataset with only a code and a date."""
    frm = f"(SELECT * FROM range_sets WHERE dataset = '{name}')"
    return consistency._union(
        _R(frm, "field", "required_field_null", "ts_code", "code IS NULL", "Required field ts_code has ", " null values", name),
        _R(frm, "logical", "future_date", "trade_date", f"d > DATE '{cross.AS_OF}'", "Date field trade_date has ", " future dates", name),
        _R(frm, "logical", "old_date", "trade_date", "d < DATE '1900-01-01'", "Date field trade_date has ", " very old dates", name),
    )


_FLOW_ISSUES = consistency._union(
    *[_plain_rules(n) for n in ("orders", "lineitem", "events")], cross.CODES, cross.RANGES,
    *[cross._temporal(n).replace(cross.OLDEST, "1900-01-01") for n in ("orders", "lineitem", "events")],
)


@query("validate_datasets", X.with_views("range_sets") + _FLOW_ISSUES)
def _(spark, d):
    return flow.validate_datasets(X.range_sets(spark, d), {}, cross.AS_OF)


@query(
    "quality_flow",
    X.with_views("range_sets", extra=f"iss AS ({_FLOW_ISSUES})") + """SELECT t.dataset, t.total_records, coalesce(i.n, 0) AS total_issues,
    round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - coalesce(i.n, 0)::DOUBLE / t.total_records)), 6) AS quality_score
    FROM (SELECT dataset, count(*) AS total_records FROM range_sets GROUP BY 1) t LEFT JOIN (SELECT dataset, count(*) AS n FROM iss GROUP BY 1) i USING (dataset)""",
)
def _(spark, d):
    result = flow.quality_flow(X.range_sets(spark, d), {}, cross.AS_OF)
    return result.scores.withColumn("quality_score", F.round("quality_score", 6))


_SEVERITY = """CASE WHEN regexp_matches(lower("check"), 'missing|null|required|invalid') THEN 'critical' WHEN regexp_matches(lower("check"), 'anomaly|inconsistency|revision') THEN 'high'
 WHEN regexp_matches(lower("check"), 'bounds|range|format') THEN 'medium' ELSE 'low' END"""
_FLOW_SUMMARY = X.with_views("range_sets", extra=f"""iss AS ({_FLOW_ISSUES}), sv AS (SELECT *, {_SEVERITY} AS severity FROM iss),
 su AS (SELECT dataset, count(*) AS total_issues, {", ".join(f"count(*) FILTER (severity = '{s}') AS {s}_issues" for s in ("critical", "high", "medium", "low"))},
  string_agg(DISTINCT scope, ',' ORDER BY scope) AS validation_types FROM sv GROUP BY dataset)""")


@query("quality_flow_summary", _FLOW_SUMMARY + "SELECT * FROM su")
def _(spark, d):
    return flow.quality_flow(X.range_sets(spark, d), {}, cross.AS_OF).summary


@query(
    "quality_flow_report",
    _FLOW_SUMMARY + f"""SELECT t.dataset, '{cross.AS_OF}' AS generated_at, total_records, coalesce(total_issues, 0) AS total_issues,
    round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - coalesce(total_issues, 0)::DOUBLE / total_records)), 6) AS quality_score,
    coalesce(critical_issues, 0) AS critical_issues, coalesce(high_issues, 0) AS high_issues, coalesce(medium_issues, 0) AS medium_issues, coalesce(low_issues, 0) AS low_issues
    FROM (SELECT dataset, count(*) AS total_records FROM range_sets GROUP BY 1) t LEFT JOIN su USING (dataset)""",
)
def _(spark, d):
    report = flow.quality_flow(X.range_sets(spark, d), {}, cross.AS_OF).report
    fields = "generated_at string, total_records long, total_issues long, quality_score double, critical_issues long, high_issues long, medium_issues long, low_issues long"
    return report.select("dataset", F.from_json("report", fields).alias("r")).select("dataset", "r.*")


@query(
    "quality_flow_revisions",
    X.with_views("statements", "statements_old", extra="""m AS (SELECT c.revenue, c.n, o.revenue AS r0, o.n AS n0, o.ts_code IS NOT NULL AS had
    FROM statements c LEFT JOIN statements_old o ON c.ts_code = o.ts_code AND c.end_date = o.end_date)""")
    + """SELECT count(*) AS total_records, count(*) FILTER (had AND revenue <> r0 AND abs((revenue - r0) / r0) >= 0.05) AS revised_records,
    count(*) FILTER (NOT had) AS new_records, count(*) FILTER (had AND revenue = r0 AND n = n0) AS unchanged_records, CAST(0 AS BIGINT) AS removed_records FROM m""",
)
def _(spark, d):
    data = {"income": X.statements(spark, d)}
    return flow.quality_flow(data, {"income": "financial"}, "2002-01-01", historical=X.statements_old(spark, d)).revisions


@query(
    "refresh_due",
    X.with_views("dims") + """SELECT code, 999999 + row_number() OVER (ORDER BY code) AS id, industry, region,
    1999999 + dense_rank() OVER (ORDER BY industry) AS industry_id, 2999999 + dense_rank() OVER (ORDER BY region) AS region_id FROM dims""",
)
def _(spark, d):
    return load.refresh_due(X.dims(spark, d), {}, 1, 1)[0]["stock"]


# -- streaming --------------------------------------------------------------


def _stream(spark, d, name):
    schema = X.table(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _orders_stream(spark, d):
    return _stream(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("ts_code"), F.date_format("o_orderdate", "yyyyMMdd").alias("trade_date"),
        F.col("o_totalprice").alias("close"),
    )


def _ingest(spark, d):
    """Orders as a stream of files into a lake by year, with a watermark."""
    root = scratch_path(spark, "stream")
    spec = YEARLY.located(root)
    stream_ingest(_orders_stream(spark, d), spec, f"{root}/progress", spec.keys, watermarks=f"{root}/marks").awaitTermination()
    return spec, f"{root}/marks"


@query(
    "stream_ingest",
    """SELECT o_orderkey, o_custkey AS ts_code, strftime(o_orderdate, '%Y%m%d') AS trade_date, o_totalprice AS close,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS trade_date_int, CAST(year(o_orderdate) AS INT) AS year FROM orders""",
)
def _(spark, d):
    return spark.read.parquet(_ingest(spark, d)[0].path)


@query(
    "stream_ingest_watermark",
    "SELECT 'sales' AS dataset, CAST(max(o_orderdate) AS DATE) AS last_update_date, count(*) AS record_count FROM orders",
)
def _(spark, d):
    return load_watermarks(spark, _ingest(spark, d)[1]).select("dataset", "last_update_date", "record_count")


class _Crash(Exception):
    pass


@query(
    "stream_ingest_retry",
    """SELECT step, n AS stored, last_update_date, n AS record_count
    FROM (SELECT count(*) AS n, CAST(max(o_orderdate) AS DATE) AS last_update_date FROM orders), (SELECT unnest(['decided', 'folder', 'moved', 'staged', 'watermark']) AS step)""",
)
def _(spark, d):
    """A crash at each step of a batch, then a second run: rows and watermark as after one run."""
    out = []
    for step in ("staged", "decided", "folder", "moved", "watermark"):
        root = scratch_path(spark, "retry")
        spec = YEARLY.located(f"{root}/lake")

        def crash(at, step=step):
            if at.startswith(step):
                raise _Crash(at)

        def run(watch, spec=spec, root=root):
            stream_ingest(_orders_stream(spark, d), spec, f"{root}/progress", spec.keys, watermarks=f"{root}/marks", watch=watch).awaitTermination()

        try:
            run(crash)
        except StreamingQueryException as e:
            if "_Crash" not in str(e):
                raise
        run(None)
        marks = load_watermarks(spark, f"{root}/marks").select("last_update_date", "record_count")
        out.append(spark.read.parquet(spec.path).agg(F.count(F.lit(1)).alias("stored")).crossJoin(marks).withColumn("step", F.lit(step)))
    return reduce(DataFrame.unionByName, out)


@query("suppress_stream", _chain(30) + _EMITTED)
def _(spark, d):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    alerts = _stream(spark, d, "events").where(F.col("event_type") == "error").select(
        F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("alert_id"), F.lit("error").alias("alert_type"),
        F.col("user_id").cast("string").alias("dataset"), F.when(F.col("value") > 100, "high").otherwise("medium").alias("severity"), "ts",
    )
    root = scratch_path(spark, "alerts")
    running = (
        suppress_stream(alerts).writeStream.format("parquet").option("path", f"{root}/emitted")
        .option("checkpointLocation", f"{root}/progress").outputMode("append").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.parquet(f"{root}/emitted")


@query("source_frame_path", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, d):
    return source_frame(spark, f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@query("repair_rules", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 100000.0::DOUBLE ELSE o_totalprice END AS o_totalprice, CAST(o_custkey AS VARCHAR) AS code FROM orders")
def _(spark, d):
    # no built-in repair, two rules of the caller's own, in their order
    rules = {
        "ceiling": lambda df: df.withColumn("o_totalprice", F.least(F.col("o_totalprice"), F.lit(100000.0))),
        "code": lambda df: df.withColumn("code", F.col("o_custkey").cast("string")).drop("o_custkey"),
    }
    orders = X.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return repair_dataset(orders, ["o_orderkey"], config=RepairConfig(repairs=(), rules=rules))[0]
