"""Writers, layout figures and upkeep over orders stored by year or month."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataward.operators import layout as L
from strataward.operators.normalize import normalize
from strataward.plans import fixtures as X
from strataward.plans.registry import Registry
from strataward.session import scratch_path, stored_frame
from strataward.sources import figures as N
from strataward.sources import fs
from strataward.sources import files as P
from strataward.sources import writer as W
from strataward.sources.catalog import NONE, YEAR, YEAR_MONTH, DatasetSpec
from strataward.sources.reader import between_dates, read_dataset

REGISTRY = Registry()
query = REGISTRY.query

YEARLY = DatasetSpec("sales", "sales", YEAR, "trade_date", ("ts_code", "trade_date_int"), keys=("o_orderkey",))
MONTHLY = DatasetSpec("sales_m", "sales_m", YEAR_MONTH, "trade_date", ("ts_code", "trade_date_int"), keys=("o_orderkey",))
SINGLE = DatasetSpec("sales_1", "sales_1", NONE, "trade_date", ("ts_code",))

_ROWS = """s AS (SELECT o_orderkey, o_custkey AS ts_code, strftime(o_orderdate, '%Y%m%d') AS trade_date, o_totalprice AS close,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS trade_date_int, CAST(year(o_orderdate) AS INT) AS year,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS year_month FROM orders)"""
_Y = f"WITH {_ROWS} SELECT * EXCLUDE (year_month) FROM s"
_M = f"WITH {_ROWS} SELECT * EXCLUDE (year) FROM s"


def _raw(spark, d):
    return X.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("ts_code"), F.date_format("o_orderdate", "yyyyMMdd").alias("trade_date"),
        F.col("o_totalprice").alias("close"),
    )


def _rows(spark, d, spec=YEARLY):
    return normalize(_raw(spark, d), spec)


def stored(spark, d, spec=YEARLY):
    """Orders written in the layout of a spec; returns the spec at its place."""
    placed = spec.located(scratch_path(spark, "lake"))
    W.write_dataset(_rows(spark, d, spec), placed)
    return placed


@query("read_dataset", f"WITH {_ROWS} SELECT o_orderkey, close FROM s WHERE trade_date_int BETWEEN 19970310 AND 19980215")
def _(spark, d):
    spec = stored(spark, d)
    return between_dates(read_dataset(spark, spec), spec, "1997-03-10", "1998-02-15").select("o_orderkey", "close")


@query("partition_files", f"WITH {_ROWS} SELECT DISTINCT 'year' AS field, CAST(year AS VARCHAR) AS value, 'year=' || year AS partition, true AS has_bytes FROM s")
def _(spark, d):
    files = P.partition_files(spark, stored(spark, d).path)
    return files.groupBy("field", "value", "partition").agg((F.sum("size_bytes") > 0).alias("has_bytes"))


@query("write_partitioned", f"WITH {_ROWS} SELECT * EXCLUDE (year_month) FROM s WHERE year <> 1997 OR o_orderkey % 2 = 0")
def _(spark, d):
    spec = stored(spark, d)
    half = _rows(spark, d).where((F.col("year") == 1997) & (F.col("o_orderkey") % 2 == 0))
    W.write_partitioned(half, spec.path, ["year"], spec.sort_fields)
    return spark.read.parquet(spec.path)


@query("write_yearly", _Y)
def _(spark, d):
    path = scratch_path(spark, "yearly")
    W.write_yearly(_rows(spark, d), path, YEARLY.sort_fields)
    return spark.read.parquet(path)


@query("write_monthly", _M)
def _(spark, d):
    path = scratch_path(spark, "monthly")
    W.write_monthly(_rows(spark, d, MONTHLY), path, MONTHLY.sort_fields)
    return spark.read.parquet(path)


@query("write_single", f"WITH {_ROWS} SELECT * EXCLUDE (year, year_month) FROM s")
def _(spark, d):
    path = scratch_path(spark, "single")
    W.write_single(_rows(spark, d, SINGLE), path, SINGLE.sort_fields)
    return spark.read.parquet(path)


@query("write_dataset", f"WITH {_ROWS} SELECT 'YEAR' AS layout, count(*) AS n, sum(year)::BIGINT AS part FROM s UNION ALL SELECT 'YEAR_MONTH', count(*), sum(year_month)::BIGINT FROM s UNION ALL SELECT 'NONE', count(*), 0 FROM s")
def _(spark, d):
    out = None
    for spec in (YEARLY, MONTHLY, SINGLE):
        placed = stored(spark, d, spec)
        part = F.sum(F.col(placed.partition_by[0]).cast("long")) if placed.partition_by else F.lit(0).cast("long")
        one = spark.read.parquet(placed.path).agg(F.lit(spec.granularity).alias("layout"), F.count(F.lit(1)).alias("n"), part.alias("part"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "upsert_partitioned",
    f"""WITH {_ROWS} SELECT o_orderkey, ts_code, trade_date, CASE WHEN o_orderkey % 2 = 0 THEN round(close + 1, 2) ELSE close END AS close, trade_date_int, year
    FROM s WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
)
def _(spark, d):
    spec = YEARLY.located(scratch_path(spark, "upsert"))
    rows, k = _rows(spark, d), F.col("o_orderkey")
    W.upsert_partitioned(rows.where(k % 3 != 0), spec.path, "year", spec.keys, sort=spec.sort_fields)
    changed = rows.where(k % 2 == 0).withColumn("close", F.round(F.col("close") + 1, 2))
    W.upsert_partitioned(changed, spec.path, "year", spec.keys, sort=spec.sort_fields)
    return spark.read.parquet(spec.path)


@query("partition_sizes", f"WITH {_ROWS} SELECT DISTINCT 'year=' || year AS partition, CAST(year AS VARCHAR) AS value, true AS sized FROM s")
def _(spark, d):
    sizes = P.partition_sizes(P.partition_files(spark, stored(spark, d).path))
    return sizes.select("partition", "value", ((F.col("size_bytes") > 0) & (F.col("file_count") > 0)).alias("sized"))


# Layout figures from a size table: one partition per order month, a million bytes per order
_SIZES = """z AS (SELECT strftime(o_orderdate, '%Y%m') AS value, CAST(count(*) * 100000 AS BIGINT) AS size_bytes FROM orders GROUP BY 1),
 mb AS (SELECT *, size_bytes / 1048576.0::DOUBLE AS mb FROM z),
 ef AS (SELECT count(*) AS partitions, sum(mb) AS total_mb, avg(mb) AS avg_mb, min(mb) AS min_mb, max(mb) AS max_mb, count(*) FILTER (mb < 10) AS small_partitions,
   greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100 - var_pop(mb) / 2500 * 100)) AS score FROM mb)"""
_ROUNDED = ("total_mb", "avg_mb", "min_mb", "max_mb", "score")
_EF = "partitions, small_partitions, " + ", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED)


def _sizes(spark, d):
    month = F.date_format("o_orderdate", "yyyyMM")
    return X.table(spark, d, "orders").groupBy(month.alias("value")).agg((F.count(F.lit(1)) * 100000).alias("size_bytes"))


@query("storage_efficiency", f"WITH {_SIZES} SELECT {_EF} FROM ef")
def _(spark, d):
    return P.storage_efficiency(_sizes(spark, d)).withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(
    "layout_advice",
    f"""WITH {_SIZES} SELECT {_EF}, CASE WHEN partitions = 0 THEN 'keep' WHEN avg_mb < 5 THEN 'merge' WHEN avg_mb > 500 THEN 'split' WHEN score < 60 THEN 'repartition' ELSE 'keep' END AS action FROM ef""",
)
def _(spark, d):
    return P.layout_advice(P.storage_efficiency(_sizes(spark, d))).withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(
    "adjacent_small_pairs",
    f"""WITH {_SIZES}, sm AS (SELECT CAST(value AS BIGINT) AS v, mb FROM mb WHERE mb < 18)
    SELECT a.v AS first_value, b.v AS second_value, round(a.mb, 6) AS first_mb, round(b.mb, 6) AS second_mb FROM sm a JOIN sm b ON b.v = a.v + 1""",
)
def _(spark, d):
    return P.adjacent_small_pairs(_sizes(spark, d), 18).withColumns({c: F.round(c, 6) for c in ("first_mb", "second_mb")})


def _scattered(spark, d, parts=6):
    """Orders by year in several files each."""
    path = scratch_path(spark, "scattered")
    _rows(spark, d).repartition(parts).write.partitionBy("year").parquet(path)
    return path


@query("compact_small", _Y)
def _(spark, d):
    path = _scattered(spark, d)
    L.compact_small(spark, path, "year", YEARLY.sort_fields)
    return spark.read.parquet(path)


@query("compact_small_files", f"WITH {_ROWS} SELECT CAST(year AS VARCHAR) AS value, true AS fewer FROM s GROUP BY year")
def _(spark, d):
    path = _scattered(spark, d)
    before = P.partition_sizes(P.partition_files(spark, path)).select("value", F.col("file_count").alias("before")).collect()
    L.compact_small(spark, path, "year", YEARLY.sort_fields)
    after = P.partition_sizes(P.partition_files(spark, path)).select("value", "file_count")
    then = spark.createDataFrame(before, "value string, before long")
    return after.join(then, "value").select("value", ((F.col("file_count") < F.col("before")) | (F.col("before") == 1)).alias("fewer"))


@query("compact_to_target", _Y)
def _(spark, d):
    path = _scattered(spark, d)
    L.compact_to_target(spark, path, "year", YEARLY.sort_fields, target_mb=0.01)
    return spark.read.parquet(path)


@query(
    "compact_ranges",
    f"""WITH {_ROWS} SELECT CAST(year AS VARCHAR) AS value, count(*) AS record_count, true AS as_planned, CAST(0 AS BIGINT) AS overlaps FROM s GROUP BY year""",
)
def _(spark, d):
    """Each year split into files of a target size along the order key: their number, and pairs of neighbours whose ranges overlap."""
    path = _scattered(spark, d)
    L.compact_to_target(spark, path, "year", ["o_orderkey"], target_mb=8.0)  # one file a year
    before = stored_frame(P.partition_sizes(P.partition_files(spark, path)).select("value", F.col("size_bytes").alias("before")), "before")
    target = before.agg(F.min("before")).first()[0] / 3.5 / 1024 / 1024  # every year is split
    wanted = before.select("value", F.floor(F.col("before") / (target * 1024 * 1024)).alias("wanted"))
    L.compact_to_target(spark, path, "year", ["o_orderkey"], target_mb=target)
    rows = spark.read.parquet(path)
    ends = rows.groupBy("year", F.col("_metadata.file_path").alias("file")).agg(
        F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"), F.count(F.lit(1)).alias("n")
    )
    last = Window.partitionBy("year").orderBy("low")
    ends = ends.withColumn("over", (F.lag("high").over(last) >= F.col("low")).cast("long"))
    per = ends.groupBy(F.col("year").cast("string").alias("value")).agg(
        F.sum("n").alias("record_count"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("over"), F.lit(0)).alias("overlaps")
    )
    checked = per.join(wanted, "value").withColumn("as_planned", (F.col("files") == F.col("wanted")) & (F.col("files") > 2))
    return checked.select("value", "record_count", "as_planned", "overlaps")


@query("recompress", _Y)
def _(spark, d):
    path = _scattered(spark, d)
    L.recompress(spark, path, "year", YEARLY.sort_fields, large_mb=0.0)
    return spark.read.parquet(path)


@query("optimize_layout", _Y)
def _(spark, d):
    path = _scattered(spark, d)
    L.optimize_layout(spark, path, "year", "auto", YEARLY.sort_fields)
    return spark.read.parquet(path)


@query("partition_stats", f"WITH {_ROWS} SELECT 'year=' || year AS partition, CAST(year AS VARCHAR) AS value, count(*) AS record_count, true AS sized FROM s GROUP BY year")
def _(spark, d):
    stats = P.partition_stats(spark, stored(spark, d).path, "year")
    return stats.select("partition", "value", "record_count", (F.col("size_bytes") > 0).alias("sized"))


@query(
    "partition_stats_refresh",
    f"""WITH {_ROWS}, t AS (SELECT *, year IN (1995, 1996) AS touched, CASE WHEN year IN (1995, 1996) THEN -1.0 ELSE close END AS price FROM s)
    SELECT 'year=' || year AS partition, count(*) AS record_count, CAST(max(touched::INT) AS INT) AS version, min(price) AS low, max(price) AS high, CAST(0 AS BIGINT) AS nulls
    FROM t GROUP BY year""",
)
def _(spark, d):
    """Figures after an upsert into two years: only these are measured again."""
    path, table = stored(spark, d).path, scratch_path(spark, "figures")
    N.create_figures(spark, path, table, ["close"])
    change = spark.read.parquet(path).where(F.col("year").isin(1995, 1996)).withColumn("close", F.lit(-1.0))
    W.upsert_partitioned(change, path, "year", ["o_orderkey"], (), YEARLY.sort_fields)
    N.refresh_figures(spark, path, table)
    files = N.load_figures(spark, table)
    ends = N.column_figures(files, {"close": "double"}).select("partition", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), "nulls")
    return N.partition_figures(files).select("partition", "record_count", "version").join(ends, "partition")


@query("expired_partitions", f"WITH {_ROWS} SELECT 'year=' || year AS partition, count(*) AS record_count FROM s WHERE year < 1998 GROUP BY year")
def _(spark, d):
    # file times are those of this run, so each year's last day stands in for them
    stats = P.partition_stats(spark, stored(spark, d).path, "year")
    stats = stats.withColumn("modified", F.concat("value", F.lit("-12-31")).cast("timestamp"))
    return L.expired_partitions(stats, "2000-06-01", 730).select("partition", "record_count")


@query(
    "archive_partitions",
    f"""WITH {_ROWS} SELECT 'kept' AS place, year, count(*) AS n FROM s WHERE year >= 1997 GROUP BY year
    UNION ALL SELECT 'archived', year, count(*) FROM s WHERE year = 1995 GROUP BY year
    UNION ALL SELECT 'copied', year, count(*) FROM s WHERE year = 1998 GROUP BY year""",
)
def _(spark, d):
    path, old, copy = stored(spark, d).path, scratch_path(spark, "archive"), scratch_path(spark, "backup")
    years = lambda y: P.partition_sizes(P.partition_files(spark, path)).where(F.col("value") == y)
    L.archive_partitions(spark, path, years("1995"), "archive", old)
    L.archive_partitions(spark, path, years("1996"), "cleanup")
    L.archive_partitions(spark, path, years("1998"), "backup", copy)
    out = None
    for place, p in (("kept", path), ("archived", old), ("copied", copy)):
        one = spark.read.parquet(p).groupBy("year").agg(F.count(F.lit(1)).alias("n")).select(F.lit(place).alias("place"), "year", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("layout_health", f"WITH {_ROWS} SELECT 'year=' || year AS partition, count(*) AS record_count, CAST(0 AS BIGINT) AS unreadable_files, true AS healthy FROM s GROUP BY year")
def _(spark, d):
    return P.layout_health(spark, stored(spark, d).path).select("partition", "record_count", "unreadable_files", "healthy")


@query(
    "layout_health_damaged",
    """SELECT 'year=' || year(o_orderdate) AS partition, CASE year(o_orderdate) WHEN 1995 THEN 'cut.parquet' WHEN 1996 THEN 'other.parquet' ELSE 'none.parquet' END AS file, true AS has_error
    FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY ALL""",
)
def _(spark, d):
    """A cut file, one of another kind and one of no bytes, each named with its error."""
    path = stored(spark, d).path
    whole = spark.read.format("binaryFile").load(f"{path}/year=1995").select("content").first()[0]
    for name, data in (("year=1995/cut", bytes(whole[: len(whole) // 2])), ("year=1996/other", b"not a table"), ("year=1997/none", b"")):
        fs.write_bytes(spark, f"{path}/{name}.parquet", data)
    found = P.damaged_files(spark, path)
    return found.select("partition", F.element_at(F.split("path", "/"), -1).alias("file"), (F.length("error") > 0).alias("has_error"))


@query(
    "validate_layout",
    """SELECT 'sales' AS dataset, 'YEAR' AS expected, 'YEAR' AS actual, count(*) > 0 AS matches FROM orders
    UNION ALL SELECT 'sales_m', 'YEAR_MONTH', 'NONE', count(*) < 0 FROM orders UNION ALL SELECT 'sales_1', 'NONE', 'NONE', count(*) > 0 FROM orders
    UNION ALL SELECT 'absent', 'YEAR', 'missing', count(*) < 0 FROM orders""",
)
def _(spark, d):
    root = scratch_path(spark, "root")
    W.write_dataset(_rows(spark, d), YEARLY.located(root))
    W.write_single(_rows(spark, d, SINGLE), f"{root}/{MONTHLY.path}")  # stored without its months
    W.write_dataset(_rows(spark, d, SINGLE), SINGLE.located(root))
    catalog = {s.name: s for s in (YEARLY, MONTHLY, SINGLE, DatasetSpec("absent", "absent", YEAR))}
    return P.validate_layout(spark, root, catalog).drop("file_count")


# event values as scan times of the partition they belong to
_SCANS = """h AS (SELECT event_type AS partition, ts, value * 10 AS ms FROM events),
 rec AS (SELECT * FROM h WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR),
 per AS (SELECT partition, count(*) AS scans, avg(ms) AS avg_ms, max(ms) AS max_ms, min(ms) AS min_ms, sum(ms) AS total_ms FROM rec GROUP BY 1),
 scan_summary AS (SELECT *, sum(total_ms) OVER () / sum(scans) OVER () AS overall_avg_ms, max(max_ms) OVER () AS overall_max_ms, min(min_ms) OVER () AS overall_min_ms,
   avg_ms > 480 AS slow FROM per)"""
_MS = ("avg_ms", "max_ms", "min_ms", "total_ms", "overall_avg_ms", "overall_max_ms", "overall_min_ms")


def _scans(spark, d):
    history = X.table(spark, d, "events").select(F.col("event_type").alias("partition"), "ts", (F.col("value") * 10).alias("query_time_ms"))
    return P.scan_time_summary(history, "2024-01-30 12:00:00", 24, 480)


@query("scan_time_summary", f"WITH {_SCANS} SELECT partition, scans, slow, {', '.join(f'round({c}, 6) AS {c}' for c in _MS)} FROM scan_summary")
def _(spark, d):
    return _scans(spark, d).withColumns({c: F.round(c, 6) for c in _MS})


@query(
    "scan_time_alerts",
    f"WITH {_SCANS} SELECT partition, round(avg_ms, 6) AS value, 480.0::DOUBLE AS threshold, 'scan of ' || partition || ' is slow' AS message FROM scan_summary WHERE avg_ms > 480",
)
def _(spark, d):
    return P.scan_time_alerts(_scans(spark, d), 480).withColumn("value", F.round("value", 6))


@query("rebuild_dataset", _M)
def _(spark, d):
    # a lake by year is rebuilt by month from its own rows
    old = spark.read.parquet(stored(spark, d).path).select("o_orderkey", "ts_code", "trade_date", "close")
    placed = MONTHLY.located(scratch_path(spark, "rebuilt"))
    L.rebuild_dataset(spark, old, placed, normalize)
    return spark.read.parquet(placed.path)


# a tenth of the orders have a date that cannot be read, in each of two loads
_UNDATED = """u AS (SELECT o_orderkey, o_custkey AS ts_code, CASE WHEN o_orderkey % 10 < 2 THEN 'n/a' ELSE strftime(o_orderdate, '%Y%m%d') END AS trade_date, o_totalprice AS close,
  CAST(CASE WHEN o_orderkey % 10 >= 2 THEN strftime(o_orderdate, '%Y%m%d') END AS INT) AS trade_date_int,
  CAST(CASE WHEN o_orderkey % 10 >= 2 THEN year(o_orderdate) END AS INT) AS year FROM orders)"""


def _undated(spark, d):
    lost = F.col("o_orderkey") % 10 < 2
    return normalize(_raw(spark, d).withColumn("trade_date", F.when(lost, "n/a").otherwise(F.col("trade_date"))), YEARLY)


def _two_loads(spark, d):
    """Even orders first, then the odd ones beside repeated even ones."""
    path = scratch_path(spark, "undated")
    rows = _undated(spark, d)
    W.upsert_partitioned(rows.where(F.col("o_orderkey") % 2 == 0), path, "year", ["o_orderkey"], (), YEARLY.sort_fields)
    W.upsert_partitioned(rows.where(F.col("o_orderkey") % 4 != 0), path, "year", ["o_orderkey"], (), YEARLY.sort_fields)
    return path


@query("upsert_undated", f"WITH {_UNDATED} SELECT * FROM u")
def _(spark, d):
    return spark.read.parquet(_two_loads(spark, d))


@query("partition_stats_undated", f"WITH {_UNDATED} SELECT CAST(year AS VARCHAR) AS value, count(*) AS record_count FROM u GROUP BY year")
def _(spark, d):
    return P.partition_stats(spark, _two_loads(spark, d), "year").select("value", "record_count")


@query(
    "compact_undated",
    f"""WITH {_UNDATED} SELECT 'rows' AS what, CAST(year AS VARCHAR) AS value, count(*) AS n FROM u GROUP BY year
    UNION ALL SELECT 'files', CAST(year AS VARCHAR), 1 FROM u GROUP BY year""",
)
def _(spark, d):
    path = scratch_path(spark, "undated")
    _undated(spark, d).repartition(6).write.partitionBy("year").parquet(path)
    L.compact_small(spark, path, "year", YEARLY.sort_fields)
    files = P.partition_sizes(P.partition_files(spark, path)).select(F.lit("files").alias("what"), "value", F.col("file_count").alias("n"))
    rows = spark.read.parquet(path).groupBy(F.col("year").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.lit("rows").alias("what"), "value", "n").unionByName(files)


@query("compact_to_target_undated", f"WITH {_UNDATED} SELECT * FROM u")
def _(spark, d):
    path = _two_loads(spark, d)
    L.compact_to_target(spark, path, "year", YEARLY.sort_fields, target_mb=0.01)
    return spark.read.parquet(path)


@query("backup_undated", f"WITH {_UNDATED} SELECT year, count(*) AS n FROM u GROUP BY year")
def _(spark, d):
    path, copy = _two_loads(spark, d), scratch_path(spark, "backup")
    L.archive_partitions(spark, path, P.partition_sizes(P.partition_files(spark, path)), "backup", copy)
    return spark.read.parquet(copy).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query("recompress_folders", f"WITH {_ROWS} SELECT DISTINCT 'year_month=' || year_month AS folder FROM s")
def _(spark, d):
    path = scratch_path(spark, "months")
    _rows(spark, d, MONTHLY).write.option("compression", "snappy").partitionBy("year_month").parquet(path)
    done = L.recompress(spark, path, "year_month", MONTHLY.sort_fields, large_mb=0.0)
    return spark.createDataFrame([(f,) for f in done], "folder string")
