"""Field and logical checks over faulty bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.functions.size import SkewPolicy
from strataward.operators import consistency as C
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query

AS_OF = "2024-01-20"
CONFIG = C.ConsistencyConfig(price_bounds=(1.0, 300.0), volume_bounds=(0.0, 5.0), oldest_date="2024-01-03")
SPLIT = SkewPolicy(mode="blocks", block_rows=64)

_VIEWS = X.with_views(
    "bars_faulty",
    extra="""checked AS (SELECT ts_code, CASE WHEN CAST(substr(ts_code, 2, 6) AS INT) % 30 <> 9 THEN trade_date END AS trade_date,
  open, CASE WHEN CAST(substr(ts_code, 2, 6) AS INT) % 45 = 8 THEN -high ELSE high END AS high, low, close, volume FROM bars_faulty),
stepped AS (SELECT *, abs((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0)) AS change
  FROM bars_faulty WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date NULLS FIRST, open))""",
)


def _checked(spark, d):
    u = F.substring("ts_code", 2, 6).cast("int")
    return X.bars_faulty(spark, d).withColumns(
        {
            "trade_date": F.when(u % 30 != 9, F.col("trade_date")),
            "high": F.when(u % 45 == 8, -F.col("high")).otherwise(F.col("high")),
        }
    )


def rule_sql(frm, scope, check, field, cond, head, tail="", dataset="bars") -> str:
    """One counting rule as an issue row."""
    return f"""SELECT '{dataset}' AS dataset, '{scope}' AS scope, '{check}' AS "check", '{field}' AS field,
      CAST(NULL AS VARCHAR) AS entity, CAST(NULL AS VARCHAR) AS period, n AS "count",
      '{head}' || CAST(n AS VARCHAR) || '{tail}' AS description
      FROM (SELECT count(*) FILTER ({cond}) AS n FROM {frm}) WHERE n > 0"""


def _union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


REQUIRED = _union(*[
    rule_sql("checked", "field", "required_field_null", c, f"{c} IS NULL", f"Required field {c} has ", " null values")
    for c in ("ts_code", "trade_date", "close")
])
PRICES = _union(*[
    r for c in ("open", "close", "high", "low") for r in (
        rule_sql("checked", "field", "negative_price", c, f"{c} < 0", f"Field {c} has ", " negative values"),
        rule_sql("checked", "field", "price_bounds", c, f"{c} < 1.0 OR {c} > 300.0", f"Field {c} has ", " values outside its bounds"),
    )
])
VOLUME = _union(
    rule_sql("checked", "field", "negative_volume", "volume", "volume < 0", "Field volume has ", " negative values"),
    rule_sql("checked", "field", "volume_bounds", "volume", "volume < 0 OR volume > 5", "Field volume has ", " values outside its bounds"),
)
NULL_DATES = rule_sql("checked", "field", "null_date", "trade_date", "trade_date IS NULL", "Date field trade_date has ", " null values")
OHLC = _union(
    rule_sql("checked", "logical", "ohlc_high", "high",
             "open IS NOT NULL AND close IS NOT NULL AND high < greatest(open, close)", "", " records have a high below open or close"),
    rule_sql("checked", "logical", "ohlc_low", "low",
             "open IS NOT NULL AND close IS NOT NULL AND low > least(open, close)", "", " records have a low above open or close"),
)
CHANGE = rule_sql("stepped", "logical", "price_change", "close", "change > 0.2", "Close changes by more than 20% in ", " records")
BOUNDS = _union(
    rule_sql("checked", "logical", "future_date", "trade_date", "strptime(trade_date, '%Y%m%d') > TIMESTAMP '2024-01-20'",
             "Date field trade_date has ", " future dates"),
    rule_sql("checked", "logical", "old_date", "trade_date", "strptime(trade_date, '%Y%m%d') < TIMESTAMP '2024-01-03'",
             "Date field trade_date has ", " very old dates"),
)


@query("check_required", _VIEWS + REQUIRED)
def _(spark, d):
    return C.check_required(_checked(spark, d), "bars", "stock")


@query("check_price_fields", _VIEWS + PRICES)
def _(spark, d):
    return C.check_price_fields(_checked(spark, d), "bars", CONFIG)


@query("check_volume", _VIEWS + VOLUME)
def _(spark, d):
    return C.check_volume(_checked(spark, d), "bars", CONFIG)


@query("check_null_dates", _VIEWS + NULL_DATES)
def _(spark, d):
    return C.check_null_dates(_checked(spark, d), "bars")


@query("check_ohlc", _VIEWS + OHLC)
def _(spark, d):
    return C.check_ohlc(_checked(spark, d), "bars")


@query("check_price_change", _VIEWS + CHANGE)
def _(spark, d):
    return C.check_price_change(X.bars_faulty(spark, d), "bars", ["trade_date"], ["ts_code"])


@query("check_price_change_split", _VIEWS + CHANGE)
def _(spark, d):
    return C.check_price_change(X.bars_faulty(spark, d), "bars", ["trade_date"], ["ts_code"], policy=SPLIT)


@query("check_date_bounds", _VIEWS + BOUNDS)
def _(spark, d):
    return C.check_date_bounds(_checked(spark, d), "bars", AS_OF, CONFIG)


@query(
    "check_date_bounds_second",
    """SELECT 'orders' AS dataset, 'logical' AS scope, 'future_date' AS "check", 'ship_date' AS field, CAST(NULL AS VARCHAR) AS entity,
    CAST(NULL AS VARCHAR) AS period, count(*) AS "count", 'Date field ship_date has ' || count(*) || ' future dates' AS description
    FROM orders WHERE o_orderkey % 3 = 0""",
)
def _(spark, d):
    # the first date column is sound, the second is not
    day = F.col("o_orderdate").cast("date")
    o = X.table(spark, d, "orders").select(
        "o_orderkey", day.alias("trade_date"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("2999-01-01").cast("date")).otherwise(day).alias("ship_date")
    )
    return C.check_date_bounds(o, "orders", AS_OF)


_ALL = _VIEWS.rstrip().replace("FROM bars_faulty WINDOW", "FROM checked WINDOW") + "\n"
_ALL_RULES = _union(REQUIRED, PRICES, VOLUME, NULL_DATES, OHLC, BOUNDS, CHANGE)


@query("validate_consistency", _ALL + _ALL_RULES)
def _(spark, d):
    bars = _checked(spark, d)
    return C.validate_consistency(bars, "bars", "stock", AS_OF, ["trade_date", "open"], ["ts_code"], CONFIG)


@query(
    "consistency_verdict",
    _ALL + f"SELECT (SELECT count(*) FROM checked) AS total_records, count(*) AS failed_checks, count(*) = 0 AS overall_valid FROM ({_ALL_RULES})",
)
def _(spark, d):
    bars = _checked(spark, d)
    issues = C.validate_consistency(bars, "bars", "stock", AS_OF, ["trade_date", "open"], ["ts_code"], CONFIG)
    return C.verdict(issues, bars.agg(F.count(F.lit(1)).alias("total_records")))
