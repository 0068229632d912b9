"""Views that give driver tables the shapes of keyed, dated datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataward.functions.dates import quarter_end

# the window that contains every event day, with the weekends of its month
CALENDAR = ("2024-01-01", "2024-01-31")


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is inferred once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def code_of(user):
    return F.concat(F.lit("U"), F.lpad(user.cast("string"), 6, "0"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily open, high, low, close and volume per user."""
    e = table(spark, sf_dir, "events")
    return (
        e.groupBy("user_id", F.col("ts").cast("date").alias("d"))
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select(
            code_of(F.col("user_id")).alias("ts_code"),
            F.date_format("d", "yyyyMMdd").alias("trade_date"),
            "open",
            "high",
            "low",
            "close",
            "volume",
        )
    )


def bars_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with faults placed by user number."""
    b = bars(spark, sf_dir)
    u = F.substring("ts_code", 2, 6).cast("int")
    faulty = b.withColumns(
        {
            "close": F.when(u % 50 != 7, F.col("close")),
            "high": F.when(u % 20 == 3, F.col("low")).otherwise(F.col("high")),
            "volume": F.when(u % 25 == 4, -F.col("volume")).otherwise(F.col("volume")),
        }
    )
    copies = F.when(u % 40 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return faulty.withColumn("_copy", F.explode(copies)).drop("_copy")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a series per user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("code"),
        "ts",
        F.col("event_id").alias("seq"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly revenue per customer."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("ts_code"), quarter_end(F.col("o_orderdate").cast("date")).alias("end_date"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))
    )


def statements_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier copy of the statements: some missing, some lower."""
    c = F.col("ts_code")
    return statements(spark, sf_dir).where(c % 11 != 0).withColumn(
        "revenue",
        F.when(c % 10 == 0, F.col("revenue") / 1.10)
        .when(c % 10 == 1, F.col("revenue") / 1.01)
        .otherwise(F.col("revenue")),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day between the first and last event, closed on weekends."""
    span = table(spark, sf_dir, "events").agg(
        F.min(F.col("ts").cast("date")).alias("lo"), F.max(F.col("ts").cast("date")).alias("hi")
    )
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("cal_date"))
    return days.withColumn("is_open", F.when(F.dayofweek("cal_date").isin(1, 7), 0).otherwise(1))


def dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a segment as industry and a nation as region."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    return (
        table(spark, sf_dir, "customer")
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_name").alias("code"), F.col("c_mktsegment").alias("industry"), "region")
    )


def ref_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_custkey") % 7 != 0).select("c_custkey")


def range_sets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three datasets with a code and a date."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    events = table(spark, sf_dir, "events")
    return {
        "orders": orders.select(F.col("o_custkey").alias("ts_code"), F.col("o_orderdate").cast("date").alias("trade_date")),
        "lineitem": lines.select(F.col("l_suppkey").alias("ts_code"), F.col("l_shipdate").cast("date").alias("trade_date")),
        "events": events.select(F.col("user_id").alias("ts_code"), F.col("ts").cast("date").alias("trade_date")),
    }


def metrics_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quality record per event type and day."""
    issues = F.sum((F.col("value") > 300).cast("long"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("dataset"), F.col("ts").cast("date").alias("d"))
        .agg(issues.alias("total_issues"), F.count(F.lit(1)).alias("total_records"))
        .select(
            "dataset",
            F.col("d").cast("timestamp_ntz").alias("ts"),
            (1 - F.col("total_issues") / F.col("total_records")).alias("quality_score"),
            "total_issues",
            "total_records",
        )
    )


def alert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as raised alerts."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "error")
        .select(
            F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("alert_id"),
            F.lit("error").alias("alert_type"),
            F.col("user_id").cast("string").alias("dataset"),
            F.when(F.col("value") > 100, "high").otherwise("medium").alias("severity"),
            "ts",
        )
    )


# The same views for DuckDB, one common table expression each.
SQL = {
    "bars": """bars AS (
  SELECT 'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS ts_code, strftime(CAST(ts AS DATE), '%Y%m%d') AS trade_date,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
         count(*) AS volume
  FROM events GROUP BY user_id, CAST(ts AS DATE))""",
    "bars_faulty": """bars_u AS (SELECT *, CAST(substr(ts_code, 2, 6) AS INT) AS u FROM bars),
bars_faulty AS (
  SELECT ts_code, trade_date, open, CASE WHEN u % 20 = 3 THEN low ELSE high END AS high, low,
         CASE WHEN u % 50 <> 7 THEN close END AS close,
         CASE WHEN u % 25 = 4 THEN -volume ELSE volume END AS volume
  FROM bars_u, range(2) r(i) WHERE i = 0 OR u % 40 = 5)""",
    "ticks": """ticks AS (
  SELECT user_id AS code, ts, event_id AS seq, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume FROM events)""",
    "statements": """statements AS (
  SELECT o_custkey AS ts_code,
         CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS end_date,
         round(sum(o_totalprice), 2) AS revenue, count(*) AS n
  FROM orders GROUP BY 1, 2)""",
    "statements_old": """statements_old AS (
  SELECT ts_code, end_date,
         CASE WHEN ts_code % 10 = 0 THEN revenue / 1.10 WHEN ts_code % 10 = 1 THEN revenue / 1.01 ELSE revenue END
           AS revenue, n
  FROM statements WHERE ts_code % 11 <> 0)""",
    "calendar": """calendar AS (
  SELECT CAST(d AS DATE) AS cal_date, CASE WHEN dayofweek(d) IN (0, 6) THEN 0 ELSE 1 END AS is_open
  FROM (SELECT unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d
        FROM events))""",
    "dims": """dims AS (
  SELECT c_name AS code, c_mktsegment AS industry, n_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "range_sets": """range_sets AS (
  SELECT 'orders' AS dataset, o_custkey AS code, CAST(o_orderdate AS DATE) AS d FROM orders
  UNION ALL SELECT 'lineitem', l_suppkey, CAST(l_shipdate AS DATE) FROM lineitem
  UNION ALL SELECT 'events', user_id, CAST(ts AS DATE) FROM events)""",
    "metrics_hist": """metrics_hist AS (
  SELECT event_type AS dataset, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ts,
         1 - CAST(count(*) FILTER (value > 300) AS DOUBLE) / count(*) AS quality_score,
         count(*) FILTER (value > 300) AS total_issues, count(*) AS total_records
  FROM events GROUP BY event_type, CAST(ts AS DATE))""",
    "alert_feed": """alert_feed AS (
  SELECT 'a' || CAST(event_id AS VARCHAR) AS alert_id, 'error' AS alert_type, CAST(user_id AS VARCHAR) AS dataset,
         CASE WHEN value > 100 THEN 'high' ELSE 'medium' END AS severity, ts
  FROM events WHERE event_type = 'error')""",
}

_NEEDS = {"bars_faulty": ["bars"], "statements_old": ["statements"]}


def with_views(*names: str, extra: str = "", recursive: bool = False) -> str:
    """WITH clause that defines the named views."""
    wanted: list[str] = []
    for name in names:
        for dep in [*_NEEDS.get(name, []), name]:
            if dep not in wanted:
                wanted.append(dep)
    parts = [SQL[n] for n in wanted] + ([extra] if extra else [])
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"
