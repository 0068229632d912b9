"""Revisions between two copies of quarterly statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.operators import revision as R
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

_BOTH = X.with_views(
    "statements", "statements_old",
    extra="""m AS (SELECT c.ts_code, c.end_date, c.revenue, c.n, o.revenue AS r0, o.n AS n0, o.ts_code IS NOT NULL AS had
  FROM statements c LEFT JOIN statements_old o ON c.ts_code = o.ts_code AND c.end_date = o.end_date)""",
)


def _copies(spark, d):
    return X.statements(spark, d), X.statements_old(spark, d)


@query("new_records", _BOTH + "SELECT ts_code, end_date, revenue, n FROM m WHERE NOT had")
def _(spark, d):
    return R.new_records(*_copies(spark, d))


@query("removed_records", _BOTH + "SELECT ts_code, end_date, revenue, n FROM m WHERE NOT had")
def _(spark, d):
    new, old = _copies(spark, d)
    return R.removed_records(old, new)


@query(
    "detect_revisions",
    _BOTH + """SELECT ts_code, end_date, 'revenue' AS field, round(r0, 6) AS old_value, revenue AS new_value,
  round((revenue - r0) / r0, 6) AS change_pct, round(abs(revenue - r0), 6) AS abs_change
FROM m WHERE had AND revenue <> r0 AND abs((revenue - r0) / r0) >= 0.05""",
)
def _(spark, d):
    out = R.detect_revisions(*_copies(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("old_value", "change_pct", "abs_change")})


@query("unchanged_records", _BOTH + "SELECT ts_code, end_date FROM m WHERE had AND revenue = r0 AND n = n0")
def _(spark, d):
    return R.unchanged_records(*_copies(spark, d))


@query(
    "revision_stats",
    _BOTH + """SELECT count(*) AS total_records, count(*) FILTER (had AND revenue <> r0 AND abs((revenue - r0) / r0) >= 0.05) AS revised_records,
  count(*) FILTER (NOT had) AS new_records, count(*) FILTER (had AND revenue = r0 AND n = n0) AS unchanged_records,
  CAST(0 AS BIGINT) AS removed_records FROM m""",
)
def _(spark, d):
    return R.revision_stats(*_copies(spark, d))


@query(
    "revision_history",
    """SELECT o_custkey AS ts_code, o_orderkey AS version, o_totalprice AS revenue FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) <= 3""",
)
def _(spark, d):
    versions = X.table(spark, d, "orders").select(
        F.col("o_custkey").alias("ts_code"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("revenue")
    )
    return R.revision_history(versions, ["ts_code"], ["version"], 3)
