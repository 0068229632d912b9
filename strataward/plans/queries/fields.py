"""Field names, dates, partition columns, numbers, codes and types."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataward.functions import dates, text
from strataward.operators import normalize as N
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry
from strataward.sources.catalog import YEAR, YEAR_MONTH, dataset

REGISTRY = Registry()
query = REGISTRY.query


@query("rename_aliases", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS trade_date, o_custkey AS ts_code, o_totalprice AS close FROM orders")
def _(spark, d):
    o = X.table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_custkey").alias("stock_code"),
        F.col("o_totalprice").alias("close"),
    )
    return N.rename_aliases(o)


@query(
    "add_date_int",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
       CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS ship_date_int FROM lineitem""",
)
def _(spark, d):
    li = X.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
    )
    return N.add_date_int(li, "ship_date")


@query(
    "add_partition_cols",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS o_orderdate_int,
       CAST(year(o_orderdate) AS INT) AS year, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS year_month
       FROM orders""",
)
def _(spark, d):
    o = X.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return N.add_partition_cols(N.add_partition_cols(o, "o_orderdate", YEAR), "o_orderdate", YEAR_MONTH)


@query(
    "coerce_numeric",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS close,
       o_totalprice AS amount FROM orders""",
)
def _(spark, d):
    money = F.format_number("o_totalprice", 2)
    o = X.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(money).alias("close"),
        F.col("o_totalprice").alias("amount"),
    )
    return N.coerce_numeric(o)


# one text per row in a layout picked by the order number
_LAYOUTS_SQL = """mixed AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 7 AS k,
    CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '%Y-%m')
      WHEN 4 THEN strftime(o_orderdate, '%Y%m') WHEN 5 THEN ' ' || strftime(o_orderdate, '%Y%m%d') || ' '
      ELSE 'day ' || strftime(o_orderdate, '%d') END AS raw
  FROM orders)"""


def _mixed(spark, d):
    at = F.col("o_orderdate")
    k = F.col("o_orderkey") % 7
    formats = {0: "yyyyMMdd", 1: "yyyy-MM-dd", 2: "yyyy/MM/dd", 3: "yyyy-MM", 4: "yyyyMM"}
    raw = F.concat(F.lit("day "), F.date_format(at, "dd"))
    raw = F.when(k == 5, F.concat(F.lit(" "), F.date_format(at, "yyyyMMdd"), F.lit(" "))).otherwise(raw)
    for i, f in formats.items():
        raw = F.when(k == i, F.date_format(at, f)).otherwise(raw)
    return X.table(spark, d, "orders").select("o_orderkey", raw.alias("raw"))


@query(
    "parse_date",
    f"""WITH {_LAYOUTS_SQL}
    SELECT o_orderkey, raw, CASE WHEN k IN (0, 1, 2, 5) THEN d WHEN k = 3 THEN CAST(date_trunc('month', d) AS DATE)
      WHEN k = 4 AND month(d) % 3 = 0 THEN last_day(d) END AS parsed FROM mixed""",
)
def _(spark, d):
    return _mixed(spark, d).withColumn("parsed", dates.parse_date("raw"))


@query(
    "canonical_date_text",
    f"""WITH {_LAYOUTS_SQL}
    SELECT o_orderkey, raw, CASE WHEN length(regexp_replace(raw, '[-/]', '', 'g')) >= 8
      THEN substr(regexp_replace(raw, '[-/]', '', 'g'), 1, 8) END AS canonical FROM mixed""",
)
def _(spark, d):
    return _mixed(spark, d).withColumn("canonical", dates.canonical_date_text("raw"))


@query(
    "code_from_path",
    """WITH p AS (SELECT c_custkey, c_custkey % 6 AS k, lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS n FROM customer),
    q AS (SELECT c_custkey, k, n, CASE k WHEN 0 THEN '/lake/daily/' || n || '_SZ.parquet' WHEN 1 THEN '/lake/daily/SH' || n || '.parquet'
      WHEN 2 THEN '/lake/daily/' || n || '.SZ.parquet' WHEN 3 THEN '/lake/daily/' || CAST(600000 + c_custkey % 1000 AS VARCHAR) || '.parquet'
      WHEN 4 THEN '/lake/daily/ts_code=' || n || '.BJ/part.parquet' ELSE '/lake/daily/part.parquet' END AS path FROM p)
    SELECT path, CASE k WHEN 0 THEN n || '.SZ' WHEN 1 THEN n || '.SH' WHEN 2 THEN n || '.SZ'
      WHEN 3 THEN CAST(600000 + c_custkey % 1000 AS VARCHAR) || '.SH' WHEN 4 THEN n || '.BJ' END AS code FROM q""",
)
def _(spark, d):
    k, key = F.col("c_custkey") % 6, F.col("c_custkey")
    n = F.lpad((key % 1000000).cast("string"), 6, "0")
    six = (600000 + key % 1000).cast("string")
    path = (
        F.when(k == 0, F.concat(F.lit("/lake/daily/"), n, F.lit("_SZ.parquet")))
        .when(k == 1, F.concat(F.lit("/lake/daily/SH"), n, F.lit(".parquet")))
        .when(k == 2, F.concat(F.lit("/lake/daily/"), n, F.lit(".SZ.parquet")))
        .when(k == 3, F.concat(F.lit("/lake/daily/"), six, F.lit(".parquet")))
        .when(k == 4, F.concat(F.lit("/lake/daily/ts_code="), n, F.lit(".BJ/part.parquet")))
        .otherwise(F.lit("/lake/daily/part.parquet"))
    )
    return X.table(spark, d, "customer").select(path.alias("path")).withColumn("code", text.code_from_path("path"))


@query(
    "infer_type",
    """WITH p AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '/lake/Daily/x' WHEN 1 THEN '/lake/basic/x' WHEN 2 THEN '/lake/income/x'
      WHEN 3 THEN '/lake/index/x' WHEN 4 THEN '/lake/fund/x' WHEN 5 THEN '/lake/daily_basic/x' ELSE '/lake/other/x' END AS path FROM part)
    SELECT p_partkey, path, CASE p_partkey % 7 WHEN 0 THEN 'stock' WHEN 1 THEN 'daily_basic' WHEN 2 THEN 'financial' WHEN 3 THEN 'index'
      WHEN 4 THEN 'fund' WHEN 5 THEN 'stock' ELSE 'unknown' END AS dataset_type FROM p""",
)
def _(spark, d):
    words = F.array(*[F.lit(w) for w in ("Daily", "basic", "income", "index", "fund", "daily_basic", "other")])
    path = F.concat(F.lit("/lake/"), F.element_at(words, (F.col("p_partkey") % 7 + 1).cast("int")), F.lit("/x"))
    return (
        X.table(spark, d, "part").select("p_partkey", path.alias("path"))
        .withColumn("dataset_type", text.infer_type("path"))
    )


@query(
    "hash_id",
    "SELECT c_name AS code, true AS in_range, true AS stable FROM customer",
)
def _(spark, d):
    # Spark's hash has no SQL twin, so the properties that callers rely on are checked
    c = X.table(spark, d, "customer").select(F.col("c_name").alias("code"))
    h = text.hash_id("code")
    return c.select("code", h.between(0, text.HASH_SPACE - 1).alias("in_range"), (h == text.hash_id(F.concat("code", F.lit("")))).alias("stable"))


@query(
    "normalize_bars",
    X.with_views("bars")
    + """SELECT ts_code, trade_date, open, high, low, close, volume, CAST(trade_date AS INT) AS trade_date_int,
    CAST(substr(trade_date, 1, 4) AS INT) AS year FROM bars""",
)
def _(spark, d):
    raw = X.bars(spark, d).withColumnsRenamed({"ts_code": "code", "trade_date": "tradedate"})
    return N.normalize(raw, dataset("daily"))


@query(
    "business_days",
    X.with_views("calendar") + "SELECT cal_date FROM calendar WHERE is_open = 1 AND cal_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'",
)
def _(spark, d):
    return dates.business_days(spark, "2024-01-05", "2024-01-25", X.calendar(spark, d))


@query(
    "report_periods",
    """SELECT q.period, count(DISTINCT o_custkey) AS customers FROM
    (SELECT CAST(d + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period
     FROM (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1999-10-01', INTERVAL 3 MONTH)) AS d)) q
    LEFT JOIN orders ON CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) = q.period
    WHERE q.period BETWEEN DATE '1996-02-10' AND DATE '1999-11-15' GROUP BY 1""",
)
def _(spark, d):
    # quarters of the range with how many customers ordered in each
    periods = dates.report_periods(spark, "1996-02-10", "1999-11-15")
    o = X.table(spark, d, "orders").select("o_custkey", dates.quarter_end(F.col("o_orderdate").cast("date")).alias("period"))
    return periods.join(o, "period", "left").groupBy("period").agg(F.count_distinct("o_custkey").alias("customers"))
