"""Coverage, gaps, interval unions and load plans over daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.operators import coverage as C
from strataward.operators import planning as P
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry
from strataward.sources.catalog import NONE, YEAR, YEAR_MONTH, DatasetSpec, dataset, due_datasets, select_strategy

REGISTRY = Registry()
query = REGISTRY.query

START, END = "2024-01-03", "2024-02-05"

# some rows have no usable date; some codes have none at all
_SPOILT = """sp AS (SELECT ts_code AS code, CASE WHEN u % 45 = 8 OR (u % 10 = 9 AND trade_date LIKE '%5') THEN NULL
    ELSE CAST(strptime(trade_date, '%Y%m%d') AS DATE) END AS d FROM (SELECT *, CAST(substr(ts_code, 2, 6) AS INT) AS u FROM bars)),
days AS (SELECT code, d, count(*) AS n FROM sp GROUP BY code, d),
nx AS (SELECT *, CASE WHEN d IS NOT NULL THEN lead(d) OVER (PARTITION BY code ORDER BY d NULLS FIRST) END AS nd FROM days)"""
_PLAIN = X.with_views("bars", extra=_SPOILT + """, runs AS (SELECT *, CASE WHEN nd - d > 1 THEN d + 1 END AS gs, CASE WHEN nd - d > 1 THEN nd - 1 END AS ge,
  CASE WHEN nd - d > 1 THEN CAST(nd - d - 1 AS INT) END AS gd FROM nx)""")
_OPEN = X.with_views("bars", "calendar", extra=_SPOILT + """, runs AS (SELECT *, CASE WHEN m > 0 THEN m END AS gd,
    CASE WHEN m > 0 THEN (SELECT min(cal_date) FROM calendar WHERE is_open = 1 AND cal_date > d) END AS gs,
    CASE WHEN m > 0 THEN (SELECT max(cal_date) FROM calendar WHERE is_open = 1 AND cal_date < nd) END AS ge
  FROM (SELECT *, CAST((SELECT count(*) FROM calendar WHERE is_open = 1 AND cal_date > d AND cal_date < nd) AS INT) AS m FROM nx))""")
_COV = """SELECT 'bars' AS dataset, code, min(d) AS min_date, max(d) AS max_date, CAST(sum(n) AS BIGINT) AS record_count, count(d) AS distinct_dates,
  count(gs) AS gap_count, CAST(coalesce(sum(n) FILTER (d IS NULL), 0) AS BIGINT) AS invalid_dates FROM runs GROUP BY code"""


def _spoilt(spark, d):
    u = F.substring("ts_code", 2, 6).cast("int")
    bad = F.when(u % 45 == 8, "bad").when((u % 10 == 9) & F.col("trade_date").endswith("5"), "n/a")
    return X.bars(spark, d).select("ts_code", F.coalesce(bad, "trade_date").alias("trade_date"))


def _cov(spark, d, calendar=None):
    return C.coverage(_spoilt(spark, d), "bars", "ts_code", "trade_date", calendar)


@query("coverage", _PLAIN + _COV)
def _(spark, d):
    return _cov(spark, d)


@query("coverage_calendar", _OPEN + _COV)
def _(spark, d):
    return _cov(spark, d, X.calendar(spark, d))


@query(
    "coverage_totals",
    _PLAIN + f"""SELECT dataset, min(min_date) AS min_date, max(max_date) AS max_date, CAST(sum(record_count) AS BIGINT) AS record_count,
    count(*) AS codes, count(*) FILTER (gap_count = 0) AS complete_codes FROM ({_COV}) GROUP BY dataset""",
)
def _(spark, d):
    return C.coverage_totals(_cov(spark, d))


@query("completeness", _PLAIN + f"SELECT dataset, code, gap_count, gap_count = 0 AS is_complete FROM ({_COV})")
def _(spark, d):
    return C.completeness(_cov(spark, d))


_GAPS = "SELECT 'bars' AS dataset, code, gs AS gap_start, ge AS gap_end, gd AS gap_days FROM runs WHERE gs IS NOT NULL"


@query("find_gaps", _PLAIN + _GAPS)
def _(spark, d):
    return C.find_gaps(_spoilt(spark, d), "bars", "ts_code", "trade_date")


@query("find_gaps_calendar", _OPEN + _GAPS)
def _(spark, d):
    return C.find_gaps(_spoilt(spark, d), "bars", "ts_code", "trade_date", X.calendar(spark, d))


@query(
    "merge_periods",
    """WITH p AS (SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) AS e FROM orders),
    r AS (SELECT *, max(e) OVER (PARTITION BY code ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p),
    i AS (SELECT *, sum(CASE WHEN s <= reach + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY code ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r)
    SELECT code, min(s) AS period_start, max(e) AS period_end FROM i GROUP BY code, island""",
)
def _(spark, d):
    day = F.col("o_orderdate").cast("date")
    periods = X.table(spark, d, "orders").select(
        F.col("o_custkey").alias("code"), day.alias("period_start"),
        F.date_add(day, (F.col("o_orderkey") % 90).cast("int")).alias("period_end"),
    )
    return C.merge_periods(periods, ["code"])


@query(
    "date_coverage",
    """SELECT 'orders' AS dataset, min(t) AS min_day, max(t) AS max_day, count(DISTINCT t) AS distinct_days
    FROM (SELECT strftime(o_orderdate, '%Y%m%d') AS t FROM orders)""",
)
def _(spark, d):
    o = X.table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))
    return C.date_coverage(o, "orders", "order_date")


@query(
    "dataset_inventory",
    """SELECT 'orders' AS dataset, count(*) AS record_count, count(DISTINCT year(o_orderdate)) AS partition_values, 'o_orderdate' AS field,
    CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date FROM orders""",
)
def _(spark, d):
    o = X.table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    return C.dataset_inventory(o, "orders", "year")


@query(
    "dataset_inventory_dates",
    """SELECT 'orders' AS dataset, count(*) AS record_count, CAST(0 AS BIGINT) AS partition_values, f.field,
    CAST(min(o_orderdate) AS DATE) + f.n AS min_date, CAST(max(o_orderdate) AS DATE) + f.n AS max_date
    FROM orders, (VALUES ('o_orderdate', 0), ('pay_date', 10), ('ship_date', 20), ('close_date', 40)) f(field, n) GROUP BY f.field, f.n""",
)
def _(spark, d):
    day = F.col("o_orderdate").cast("date")
    o = X.table(spark, d, "orders").withColumns({"pay_date": F.date_add(day, 10), "ship_date": F.date_add(day, 20), "close_date": F.date_add(day, 40)})
    return C.dataset_inventory(o, "orders")


# -- planning ---------------------------------------------------------------

_REQ = f"DATE '{START}' AS rs, DATE '{END}' AS re"
_ENDS = """SELECT dataset, code, rs AS period_start, least(min_date - 1, re) AS period_end FROM c WHERE rs <= least(min_date - 1, re)
  UNION ALL SELECT dataset, code, greatest(max_date + 1, rs), re FROM c WHERE greatest(max_date + 1, rs) <= re"""
_C = f", c AS (SELECT *, {_REQ} FROM ({_COV}))"
_UNIVERSE = "u AS (SELECT DISTINCT 'U' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code FROM customer)"
_MERGED = f""", ends AS ({_ENDS}), inside AS (SELECT 'bars' AS dataset, code, gs AS period_start, ge AS period_end FROM runs
    WHERE gs >= DATE '{START}' AND ge <= DATE '{END}'), allp AS (SELECT * FROM ends UNION ALL SELECT * FROM inside),
  ri AS (SELECT *, max(period_end) OVER (PARTITION BY code ORDER BY period_start, period_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM allp),
  ii AS (SELECT *, sum(CASE WHEN period_start <= reach + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY code ORDER BY period_start, period_end ROWS UNBOUNDED PRECEDING) AS island FROM ri),
  merged AS (SELECT dataset, code, min(period_start) AS period_start, max(period_end) AS period_end FROM ii GROUP BY dataset, code, island)"""


def _universe(spark, d):
    return X.table(spark, d, "customer").select(X.code_of(F.col("c_custkey")).alias("code"))


@query("missing_periods", _PLAIN.rstrip() + _C + _MERGED + " SELECT * FROM merged")
def _(spark, d):
    gaps = C.find_gaps(_spoilt(spark, d), "bars", "ts_code", "trade_date")
    return P.missing_periods(_cov(spark, d), START, END, gaps)


@query("missing_ends", _PLAIN.rstrip() + _C + f" {_ENDS}")
def _(spark, d):
    return P.missing_periods(_cov(spark, d), START, END)


def _plan_sql(policy: str) -> str:
    gap_full = "WHEN c.gap_count > 0 THEN 'data_gaps_detected'" if policy == "full" else ""
    periods = "ends" if policy == "full" else "merged"
    return f""", pl AS (SELECT coalesce(u.code, c.code) AS code, c.*EXCLUDE(code, dataset), CASE WHEN c.code IS NULL THEN 'no_existing_data'
      WHEN c.min_date IS NULL THEN 'invalid_date_range' {gap_full} END AS full_reason,
      coalesce(c.invalid_dates > 0 OR c.gap_count > 0, false) AS flawed FROM u FULL JOIN c ON u.code = c.code),
    pp AS (SELECT pl.*, q.period_start AS ps, q.period_end AS pe FROM pl LEFT JOIN {periods} q ON pl.code = q.code AND pl.full_reason IS NULL),
    plan AS (SELECT 'bars' AS dataset, code, CASE WHEN full_reason IS NOT NULL THEN 'full' WHEN ps IS NOT NULL THEN 'missing' ELSE 'skip' END AS action,
      CASE WHEN full_reason IS NOT NULL THEN DATE '{START}' ELSE ps END AS period_start,
      CASE WHEN full_reason IS NOT NULL THEN DATE '{END}' ELSE pe END AS period_end,
      coalesce(full_reason, CASE WHEN ps IS NOT NULL THEN CASE WHEN flawed THEN 'missing_data_with_gaps' ELSE 'missing_data_periods' END
        WHEN flawed THEN 'data_incomplete_but_no_missing_periods' ELSE 'data_fully_covered_and_complete' END) AS reason,
      min_date AS existing_start, max_date AS existing_end, CASE WHEN min_date IS NOT NULL THEN record_count ELSE 0 END AS record_count FROM pp)"""


# the request ends inside the data, so that some codes can be skipped
_SHORT = {"start": "2024-01-05", "end": "2024-01-26"}


def _plan_views(policy: str, start: str = START, end: str = END) -> str:
    text = _PLAIN.rstrip() + ", " + _UNIVERSE + _C + _MERGED + _plan_sql(policy)
    return text.replace(START, start).replace(END, end)


def _plan(spark, d, policy="full", start=START, end=END):
    gaps = C.find_gaps(_spoilt(spark, d), "bars", "ts_code", "trade_date") if policy == "missing" else None
    return P.plan_loads(_cov(spark, d), _universe(spark, d), "bars", start, end, policy, gaps)


@query("plan_loads", _plan_views("full") + " SELECT * FROM plan")
def _(spark, d):
    return _plan(spark, d)


@query("plan_loads_short", _plan_views("full", **_SHORT) + " SELECT * FROM plan")
def _(spark, d):
    return _plan(spark, d, **_SHORT)


@query("plan_loads_gaps", _plan_views("missing", **_SHORT) + " SELECT * FROM plan")
def _(spark, d):
    return _plan(spark, d, "missing", **_SHORT)


@query(
    "plan_summary",
    _plan_views("missing", **_SHORT) + ' SELECT action, count(DISTINCT code) AS codes, count(*) AS "rows" FROM plan GROUP BY action',
)
def _(spark, d):
    return P.plan_summary(_plan(spark, d, "missing", **_SHORT))


@query(
    "due_rows",
    _plan_views("missing", **_SHORT) + """ SELECT event_id, 'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS ts_code, CAST(ts AS DATE) AS d FROM events e
    WHERE EXISTS (SELECT 1 FROM plan p WHERE p.action <> 'skip' AND p.code = 'U' || lpad(CAST(e.user_id AS VARCHAR), 6, '0')
      AND CAST(e.ts AS DATE) BETWEEN p.period_start AND p.period_end)""",
)
def _(spark, d):
    source = X.table(spark, d, "events").select(
        "event_id", X.code_of(F.col("user_id")).alias("ts_code"), F.col("ts").cast("date").alias("d")
    )
    return P.due_rows(_plan(spark, d, "missing", **_SHORT), source, "ts_code", "d")


@query(
    "expand_tasks_by_code",
    f"""SELECT 'daily' AS dataset, CAST(floor((row_number() OVER (ORDER BY c_name) - 1) / 50) AS BIGINT) AS batch_no, c_name AS unit,
    DATE '{START}' AS period_start, DATE '{END}' AS period_end FROM customer""",
)
def _(spark, d):
    codes = X.table(spark, d, "customer").select(F.col("c_name").alias("code"))
    return P.expand_tasks(spark, dataset("daily"), START, END, codes)


@query(
    "expand_tasks_by_date",
    X.with_views("calendar") + """SELECT 'moneyflow' AS dataset, CAST(floor((row_number() OVER (ORDER BY cal_date) - 1) / 100) AS BIGINT) AS batch_no,
    CAST(NULL AS VARCHAR) AS unit, cal_date AS period_start, cal_date AS period_end FROM calendar
    WHERE is_open = 1 AND cal_date BETWEEN DATE '2024-01-03' AND DATE '2024-02-05'""",
)
def _(spark, d):
    return P.expand_tasks(spark, dataset("moneyflow"), START, END, calendar=X.calendar(spark, d))


@query(
    "first_missing_month",
    """WITH h AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS v FROM orders WHERE NOT (year(o_orderdate) = 1998 AND month(o_orderdate) = 5)),
    e AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-06-01', INTERVAL 1 MONTH)) AS DATE) AS m)
    SELECT min(m) AS first_missing FROM e WHERE strftime(m, '%Y%m') NOT IN (SELECT v FROM h)""",
)
def _(spark, d):
    month = F.date_format("o_orderdate", "yyyyMM")
    have = X.table(spark, d, "orders").select(month.alias("value")).where(F.col("value") != "199805").distinct()
    return P.first_missing_partition(spark, have, YEAR_MONTH, "2001-06-15", 1995)


@query(
    "first_missing_year",
    """SELECT CASE WHEN count(DISTINCT year(o_orderdate)) FILTER (year(o_orderdate) BETWEEN 1995 AND 2001) = 7 THEN DATE '2001-06-14' END AS first_missing
    FROM orders""",
)
def _(spark, d):
    have = X.table(spark, d, "orders").select(F.year("o_orderdate").alias("value")).distinct()
    return P.first_missing_partition(spark, have, YEAR, "2001-06-15", 1995)


@query("first_missing_unpartitioned", "SELECT CASE WHEN count(*) > 0 THEN DATE '2001-06-14' ELSE DATE '2005-01-01' END AS first_missing FROM orders")
def _(spark, d):
    return P.first_missing_partition(spark, X.table(spark, d, "orders").select(F.col("o_orderkey").alias("value")), NONE, "2001-06-15")


@query(
    "select_strategy",
    """SELECT event_type AS dataset, count(*) AS records, CASE event_type WHEN 'click' THEN 'YEAR' WHEN 'view' THEN 'YEAR' WHEN 'signup' THEN 'MERGE'
    ELSE 'NONE' END AS layout FROM events GROUP BY event_type""",
)
def _(spark, d):
    # event types as datasets outside the catalog, with a frequency each
    frequency = {"click": "daily", "view": "weekly", "signup": "monthly"}
    known = ("click", "view", "signup", "purchase", "error")
    layout = F.lit("NONE")
    for name in known:
        layout = F.when(F.col("dataset") == name, select_strategy(name, frequency=frequency.get(name))).otherwise(layout)
    counts = X.table(spark, d, "events").groupBy(F.col("event_type").alias("dataset")).agg(F.count(F.lit(1)).alias("records"))
    return counts.withColumn("layout", layout)


@query(
    "due_datasets",
    """SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS dataset FROM events
    WHERE event_type IN ('click', 'view') OR (event_type = 'signup' AND dayofweek(ts) = 1) OR (event_type = 'error' AND day(ts) = 1)""",
)
def _(spark, d):
    # event types as datasets: which are due on each day of the calendar
    frequency = {"click": "daily", "view": "daily", "signup": "weekly", "error": "monthly", "purchase": "yearly"}
    catalog = {n: DatasetSpec(n, n, frequency=f) for n, f in frequency.items()}
    days = X.table(spark, d, "events").select(F.col("ts").cast("date").alias("day"), F.col("event_type").alias("dataset")).distinct()
    weekday, first = F.weekday("day") == 0, F.dayofmonth("day") == 1
    due = F.lit(False)
    for monday in (False, True):
        for begins in (False, True):
            names = due_datasets(1 if monday else 3, 1 if begins else 15, catalog)
            due = due | ((weekday == F.lit(monday)) & (first == F.lit(begins)) & F.col("dataset").isin(names))
    return days.where(due)
