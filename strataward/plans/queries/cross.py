"""Checks across orders, lines and events, and against a partial reference."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.operators import cross as C
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

AS_OF, OLDEST = "2001-06-01", "1995-02-01"
_SETS = X.with_views("range_sets")

CODES = """SELECT n.dataset AS dataset, 'cross' AS scope, 'missing_stock_code' AS "check", 'ts_code' AS field,
  CAST(c.code AS VARCHAR) AS entity, CAST(NULL AS VARCHAR) AS period, CAST(1 AS BIGINT) AS "count",
  'Code ' || CAST(c.code AS VARCHAR) || ' is missing in dataset ' || n.dataset AS description
FROM (SELECT DISTINCT code FROM range_sets) c, (SELECT DISTINCT dataset FROM range_sets) n
WHERE NOT EXISTS (SELECT 1 FROM range_sets r WHERE r.code = c.code AND r.dataset = n.dataset)"""
RANGES = """SELECT a.dataset AS dataset, 'cross' AS scope, 'date_range_no_overlap' AS "check", 'trade_date' AS field,
  b.dataset AS entity, CAST(NULL AS VARCHAR) AS period, CAST(1 AS BIGINT) AS "count",
  'No overlap between ' || a.dataset || ' (' || a.lo || ' to ' || a.hi || ') and ' || b.dataset || ' (' || b.lo || ' to ' || b.hi || ')' AS description
FROM (SELECT dataset, min(d) AS lo, max(d) AS hi FROM range_sets GROUP BY 1) a
JOIN (SELECT dataset, min(d) AS lo, max(d) AS hi FROM range_sets GROUP BY 1) b
  ON a.dataset <> b.dataset AND greatest(a.lo, b.lo) > least(a.hi, b.hi)"""


def _temporal(name: str, field: str = "trade_date") -> str:
    parts = []
    for check, cond, said in (("future_date", f"d > DATE '{AS_OF}'", "future"), ("old_date", f"d < DATE '{OLDEST}'", "very old")):
        parts.append(f"""SELECT '{name}' AS dataset, 'cross' AS scope, '{check}' AS "check", '{field}' AS field,
          CAST(NULL AS VARCHAR) AS entity, CAST(NULL AS VARCHAR) AS period, n AS "count",
          'Date field {field} has ' || CAST(n AS VARCHAR) || ' {said} dates' AS description
          FROM (SELECT count(*) FILTER ({cond}) AS n FROM range_sets WHERE dataset = '{name}') WHERE n > 0""")
    return "\nUNION ALL ".join(parts)


@query("check_code_consistency", _SETS + CODES)
def _(spark, d):
    return C.check_code_consistency(X.range_sets(spark, d))


@query("check_date_alignment", _SETS + RANGES)
def _(spark, d):
    return C.check_date_alignment(X.range_sets(spark, d), "trade_date")


@query(
    "check_duplicate_entries",
    """SELECT 'lines_income' AS dataset, 'cross' AS scope, 'duplicate_financial_entry' AS "check", 'l_linenumber' AS field,
  CAST(l_orderkey AS VARCHAR) AS entity, CAST(l_linenumber AS VARCHAR) AS period, count(*) AS "count",
  'Duplicate entries for ' || l_orderkey || ' on ' || l_linenumber || ': ' || count(*) AS description
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(spark, d):
    return C.check_duplicate_entries(X.table(spark, d, "lineitem"), "lines_income", ("l_orderkey", "l_linenumber"))


@query("check_temporal", _SETS + _temporal("orders"))
def _(spark, d):
    return C.check_temporal(X.range_sets(spark, d)["orders"], "orders", AS_OF, OLDEST)


@query(
    "check_references",
    """SELECT 'orders' AS dataset, 'referential' AS scope, 'invalid_reference' AS "check", 'o_custkey' AS field,
  CAST(o_custkey AS VARCHAR) AS entity, CAST(NULL AS VARCHAR) AS period, count(*) AS "count",
  'Key ' || o_custkey || ' has no reference' AS description
FROM orders WHERE o_custkey % 7 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey""",
)
def _(spark, d):
    return C.check_references(X.table(spark, d, "orders"), X.ref_partial(spark, d), "orders", "o_custkey", "c_custkey")


@query(
    "reference_counts",
    """SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS main_keys,
  (SELECT count(*) FROM customer WHERE c_custkey % 7 <> 0) AS reference_keys,
  (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 7 = 0) AS missing_keys, false AS valid""",
)
def _(spark, d):
    return C.reference_counts(X.table(spark, d, "orders"), X.ref_partial(spark, d), "o_custkey", "c_custkey")


@query(
    "validate_cross_dataset",
    _SETS + "\nUNION ALL ".join([CODES, RANGES, _temporal("orders"), _temporal("lineitem"), _temporal("events")]),
)
def _(spark, d):
    return C.validate_cross_dataset(X.range_sets(spark, d), AS_OF, oldest=OLDEST)


@query(
    "common_columns",
    """SELECT 'ts_code' AS common_column, count(*) AS present FROM orders WHERE o_custkey IS NOT NULL
    UNION ALL SELECT 'trade_date', count(*) FROM orders WHERE o_orderdate IS NOT NULL""",
)
def _(spark, d):
    sets = X.range_sets(spark, d)
    cells = [F.struct(F.lit(c).alias("common_column"), F.count(c).alias("present")) for c in C.common_columns(sets)]
    return sets["orders"].agg(F.array(*cells).alias("a")).select(F.inline("a"))
