"""Layouts on literal rows: sinks, upsert, compaction, upkeep and health."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataward.operators import layout as L
from strataward.operators.normalize import normalize
from strataward.operators.watermark import load_watermarks
from strataward.plans import load
from strataward.sources import files as P
from strataward.sources import fs
from strataward.sources import writer as W
from strataward.sources.catalog import NONE, YEAR, YEAR_MONTH, DatasetSpec
from strataward.sources.reader import between_dates, read_dataset, source_frame
from strataward.streaming.ingest import stream_ingest

SCHEMA = "ts_code string, trade_date string, year int, value double"


def rows(spark, spec):
    return spark.createDataFrame(spec, SCHEMA)


def content(df):
    return Counter(map(tuple, df.select("ts_code", "trade_date", "year", "value").collect()))


@pytest.fixture
def lake(tmp_path):
    return f"file://{tmp_path}/lake"


def test_yearly_sink_makes_one_folder_per_year(spark, lake):
    df = rows(spark, [("000001.SZ", "20230101", 2023, 1.0), ("000002.SZ", "20230102", 2023, 2.0), ("000001.SZ", "20240101", 2024, 3.0)])
    W.write_yearly(df, lake)
    assert fs.child_folders(spark, lake) == ["year=2023", "year=2024"]
    assert content(spark.read.parquet(lake)) == content(df)


def test_replacing_one_partition_leaves_others(spark, lake):
    W.write_yearly(rows(spark, [("a", "20230101", 2023, 1.0), ("a", "20240101", 2024, 2.0)]), lake)
    W.write_yearly(rows(spark, [("b", "20240102", 2024, 3.0)]), lake)
    assert content(spark.read.parquet(lake)) == Counter({("a", "20230101", 2023, 1.0): 1, ("b", "20240102", 2024, 3.0): 1})


def test_months_next_to_years(spark, lake):
    months = spark.createDataFrame([("a", 202212), ("a", 202301), ("b", 202301)], "ts_code string, year_month int")
    W.write_monthly(months, f"{lake}/m")
    W.write_yearly(rows(spark, [("a", "20230101", 2023, 1.0)]), f"{lake}/y")
    assert fs.child_folders(spark, f"{lake}/m") == ["year_month=202212", "year_month=202301"]
    assert spark.read.parquet(f"{lake}/y").count() == 1


def test_missing_partition_column_fails(spark, lake):
    df = spark.createDataFrame([("a", 1)], "ts_code string, other int")
    with pytest.raises(ValueError, match="missing"):
        W.write_yearly(df, lake)
    with pytest.raises(ValueError, match="missing"):
        W.upsert_partitioned(df, lake, "year", ["ts_code"])
    assert not fs.exists(spark, lake)


def test_single_and_dispatch(spark, lake):
    df = spark.createDataFrame([("a", "20230331", 1.5)], "ts_code string, end_date string, revenue double")
    spec = DatasetSpec("income", lake, NONE, "end_date", ("ts_code",))
    W.write_dataset(df, spec)
    W.write_dataset(df, spec)
    assert spark.read.parquet(lake).collect() == df.collect()


def test_upsert_keeps_other_codes(spark, lake):
    W.upsert_partitioned(rows(spark, [("a", "20230101", 2023, 1.0), ("b", "20230101", 2023, 2.0)]), lake, "year", ["ts_code", "trade_date"])
    W.upsert_partitioned(rows(spark, [("b", "20230101", 2023, 9.0), ("c", "20240101", 2024, 3.0)]), lake, "year", ["ts_code", "trade_date"])
    got = {r["ts_code"]: r["value"] for r in spark.read.parquet(lake).collect()}
    assert got == {"a": 1.0, "b": 9.0, "c": 3.0}
    assert [f for f in fs.child_folders(spark, lake)] == ["year=2023", "year=2024"]


def test_upsert_by_order_keeps_the_newest(spark, lake):
    W.upsert_partitioned(rows(spark, [("a", "20230105", 2023, 5.0)]), lake, "year", ["ts_code"], ["trade_date"])
    W.upsert_partitioned(rows(spark, [("a", "20230101", 2023, 1.0)]), lake, "year", ["ts_code"], ["trade_date"])
    assert spark.read.parquet(lake).first()["value"] == 5.0


def scattered(spark, lake, n=200, parts=8):
    df = rows(spark, [(f"{i % 7:06d}.SZ", f"{2021 + i % 3}0101", 2021 + i % 3, 10.0 * i) for i in range(n)])
    df.repartition(parts).write.partitionBy("year").parquet(lake)
    return df


@pytest.mark.parametrize("step", ["merge", "compress", "repartition", "auto"])
def test_upkeep_keeps_the_rows(spark, lake, step):
    df = scattered(spark, lake)
    options = {"compress": {"large_mb": 0.0}} if step == "compress" else {}
    before = P.partition_files(spark, lake).count()
    done = L.optimize_layout(spark, lake, "year", step, ("ts_code",), **options)
    assert any(done.values())
    assert content(spark.read.parquet(lake)) == content(df)
    assert P.partition_files(spark, lake).count() < before
    assert fs.child_folders(spark, lake) == ["year=2021", "year=2022", "year=2023"]
    with pytest.raises(ValueError):
        L.optimize_layout(spark, lake, "year", "other")


def test_split_to_target_makes_more_files(spark, lake):
    df = scattered(spark, lake, 5000, 1)
    sizes = {r["value"]: r["size_bytes"] for r in P.partition_sizes(P.partition_files(spark, lake)).collect()}
    L.compact_to_target(spark, lake, "year", ("ts_code",), target_mb=min(sizes.values()) / 3 / 1024 / 1024)
    files = {r["value"]: r["file_count"] for r in P.partition_sizes(P.partition_files(spark, lake)).collect()}
    assert all(2 <= n <= 4 for n in files.values())
    assert content(spark.read.parquet(lake)) == content(df)


def test_sizes_and_advice(spark):
    mb = 1024 * 1024
    sizes = spark.createDataFrame([("p=1", "1", 4 * mb), ("p=2", "2", 2 * mb), ("p=4", "4", 3 * mb)], "partition string, value string, size_bytes long")
    e = P.storage_efficiency(sizes).first()
    assert (e["partitions"], e["total_mb"], e["avg_mb"], e["small_partitions"]) == (3, 9.0, 3.0, 3)
    assert e["score"] == pytest.approx(100 - (2 / 3) / 2500 * 100)
    assert P.layout_advice(P.storage_efficiency(sizes)).first()["action"] == "merge"
    assert [(r[0], r[1]) for r in P.adjacent_small_pairs(sizes).collect()] == [(1, 2)]
    none = P.storage_efficiency(sizes.limit(0)).first()
    assert (none["partitions"], none["total_mb"], none["score"]) == (0, 0.0, 0.0)
    assert P.layout_advice(P.storage_efficiency(sizes.limit(0))).first()["action"] == "keep"


def test_health_finds_a_damaged_file(spark, lake, tmp_path):
    scattered(spark, lake, 60, 2)
    bad = tmp_path / "lake" / "year=2021" / "part-bad.parquet"
    bad.write_bytes(b"")
    worse = tmp_path / "lake" / "year=2022" / "part-worse.parquet"
    worse.write_bytes(b"not a parquet file")
    got = {r["partition"]: r for r in P.layout_health(spark, lake).collect()}
    assert got["year=2021"]["unreadable_files"] == 1 and not got["year=2021"]["healthy"]
    assert got["year=2022"]["unreadable_files"] == 1
    assert got["year=2023"]["healthy"] and got["year=2023"]["record_count"] == 20


def test_retention(spark, lake):
    scattered(spark, lake, 30, 1)
    stats = P.partition_stats(spark, lake, "year").withColumn("modified", F.concat("value", F.lit("-06-01")).cast("timestamp"))
    old = L.expired_partitions(stats, "2023-07-01", 365)
    assert L.archive_partitions(spark, lake, old.where("value = '2021'"), "archive", f"{lake}_old") == 1
    assert fs.child_folders(spark, lake) == ["year=2022", "year=2023"]
    assert spark.read.parquet(f"{lake}_old").count() == 10
    with pytest.raises(ValueError):
        L.archive_partitions(spark, lake, old, "archive")
    assert P.infer_partition_field("year_month=202301") == "year_month" and P.infer_partition_field("x") == "year"


def test_partition_filter_prunes_and_pushes(spark, lake):
    spec = DatasetSpec("sales", lake, YEAR, "trade_date", ("ts_code",))
    df = spark.createDataFrame([("a", f"{y}0615", float(y)) for y in range(2018, 2024)], "ts_code string, trade_date string, close double")
    W.write_dataset(normalize(df, spec), spec)
    part = between_dates(read_dataset(spark, spec), spec, "20190101", "2020-12-31").select("close")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThanOrEqual(trade_date_int,20190101)" in plan
    assert "ReadSchema: struct<close:double,trade_date_int:int>" in plan
    assert sorted(r[0] for r in part.collect()) == [2019.0, 2020.0]
    assert read_dataset(spark, lake, ["close"], 2).count() == 2
    with pytest.raises(ValueError):
        source_frame(spark, None)


def test_load_modes(spark, lake):
    spec = DatasetSpec("bars", lake, YEAR, "trade_date", ("ts_code",))
    df = spark.createDataFrame([("a", "20230101", "1,000.5"), ("b", "20240101", "2")], "code string, tradedate string, close string")
    issues = load.run_load(spark, spec, df, keys=["ts_code", "trade_date"], validate_as_of="2023-06-01", order=["trade_date"])
    assert {r["check"] for r in issues.collect()} >= {"future_date"}
    assert {r["close"] for r in spark.read.parquet(lake).collect()} == {1000.5, 2.0}
    with pytest.raises(ValueError):
        load.run_load(spark, spec, df)
    with pytest.raises(ValueError):
        load.run_load(spark, spec, df, mode="other")
    with pytest.raises(ValueError):
        L.rebuild_dataset(spark, df, DatasetSpec("x", lake), normalize)


def test_stream_ingest_in_two_runs(spark, tmp_path):
    """Later files update earlier keys; a rerun without new files changes nothing."""
    base = f"file://{tmp_path}"
    spec = DatasetSpec("bars", f"{base}/lake", YEAR_MONTH, "trade_date", ("ts_code",))
    fields = "ts_code string, trade_date string, close double"

    def run():
        source = spark.readStream.schema(fields).parquet(f"{base}/in")
        stream_ingest(source, spec, f"{base}/progress", ["ts_code", "trade_date"], watermarks=f"{base}/marks").awaitTermination()

    spark.createDataFrame([("a", "20230105", 1.0), ("b", "20230210", 2.0)], fields).write.mode("append").parquet(f"{base}/in")
    run()
    spark.createDataFrame([("a", "20230105", 9.0), ("a", "20230301", 3.0), ("c", "20221230", 4.0)], fields).write.mode("append").parquet(f"{base}/in")
    run()
    run()
    got = {(r["ts_code"], r["trade_date"]): r["close"] for r in spark.read.parquet(spec.path).collect()}
    assert got == {("a", "20230105"): 9.0, ("b", "20230210"): 2.0, ("a", "20230301"): 3.0, ("c", "20221230"): 4.0}
    mark = load_watermarks(spark, f"{base}/marks").first()
    assert (str(mark["last_update_date"]), mark["record_count"]) == ("2023-03-01", 4)


def test_crash_between_folders_is_made_good(spark, tmp_path, monkeypatch):
    """A commit of three folders stopped after the first: readers of the dataset see all or nothing of it."""
    from strataward.sources import journal

    path = f"file://{tmp_path}/lake"
    rows = lambda v: spark.createDataFrame([(y, f"k{y}", v) for y in (2020, 2021, 2022)], "year int, k string, v int")
    W.upsert_partitioned(rows(1), path, "year", ["k"])
    whole, moves = journal.fs.move, []

    def stop(sp, src, dst):
        if "__staging" in src and len(moves) == 1:
            raise OSError("stopped")
        whole(sp, src, dst)
        if "__staging" in src:
            moves.append(dst)

    monkeypatch.setattr(journal.fs, "move", stop)
    with pytest.raises(OSError):
        W.upsert_partitioned(rows(2), path, "year", ["k"])
    monkeypatch.setattr(journal.fs, "move", whole)
    assert {r["v"] for r in read_dataset(spark, path).collect()} == {2}
    assert read_dataset(spark, path).count() == 3 and journal.records(spark, path) == []

    # a crash before the commit is decided: the old rows
    monkeypatch.setattr(journal, "save", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        W.upsert_partitioned(rows(3), path, "year", ["k"])
    assert {r["v"] for r in read_dataset(spark, path).collect()} == {2}


@pytest.mark.parametrize("step", ["staged", "decided", "folder year_month=202301", "moved", "watermark"])
def test_ingest_counts_a_batch_once(spark, tmp_path, step):
    """Two rows stored; a batch of three is stopped at a step and comes again."""
    from strataward.streaming.ingest import ingest_batch

    base = f"file://{tmp_path}"
    spec = DatasetSpec("bars", f"{base}/lake", YEAR_MONTH, "trade_date", ("ts_code",))
    fields = "ts_code string, trade_date string, close double"
    keys = ["ts_code", "trade_date"]
    take = lambda rows, n, watch=None: ingest_batch(spark.createDataFrame(rows, fields), spec, None, keys, [], f"{base}/marks", "feed", n, watch)

    def stop(at):
        if at == step:
            raise RuntimeError(at)

    second = [("a", "20230105", 9.0), ("c", "20230106", 3.0), ("d", "20230301", 4.0)]
    assert take([("a", "20230105", 1.0), ("b", "20230210", 2.0)], 0)
    with pytest.raises(RuntimeError):
        take(second, 1, stop)
    take(second, 1)
    assert not take(second, 1)
    mark = load_watermarks(spark, f"{base}/marks").first()
    assert (str(mark["last_update_date"]), mark["record_count"]) == ("2023-03-01", 4)
    assert {(r["ts_code"], r["close"]) for r in spark.read.parquet(spec.path).collect()} == {("a", 9.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)}


def test_figures_follow_the_change(spark, tmp_path):
    """A refresh reads changed files only: an untouched one is spoilt on the side, and nobody notices."""
    import glob
    import os

    from strataward.sources import figures as N

    base = f"file://{tmp_path}"
    path, table = f"{base}/lake", f"{base}/figures"
    rows = lambda y, vs: spark.createDataFrame([(y, f"k{i}", v) for i, v in enumerate(vs)], "year int, k string, v double")
    for y, vs in ((2020, [1.0, None]), (2021, [3.0, 4.0]), (2022, [5.0])):
        W.upsert_partitioned(rows(y, vs), path, "year", ["k"])
    N.create_figures(spark, path, table, ["v"])
    at = lambda: {r["partition"]: (r["record_count"], r["version"]) for r in N.partition_figures(N.load_figures(spark, table)).collect()}
    assert at() == {"year=2020": (2, 0), "year=2021": (2, 0), "year=2022": (1, 0)}
    assert N.refresh_figures(spark, path, table) == 0

    untouched = glob.glob(f"{tmp_path}/lake/year=2020/*.parquet")[0]
    old = os.stat(untouched)
    with open(untouched, "r+b") as f:
        f.write(b"x" * old.st_size)
    os.utime(untouched, ns=(old.st_atime_ns, old.st_mtime_ns))
    spark.catalog.refreshByPath(path)
    W.write_partitioned(rows(2022, [6.0, 7.0, None]), path, ["year"])
    fs.delete(spark, f"{path}/year=2021")
    assert N.refresh_figures(spark, path, table) == 1
    assert at() == {"year=2020": (2, 0), "year=2022": (3, 1)}
    got = {r["partition"]: (r["low"], r["high"], r["nulls"]) for r in N.column_figures(N.load_figures(spark, table), {"v": "double"}).collect()}
    assert got == {"year=2020": ("1.0", "1.0", 1), "year=2022": ("6.0", "7.0", 1)}
    N.delete_figures(spark, table, ["year=2022"])
    assert set(at()) == {"year=2020"}
    assert N.refresh_figures(spark, path, table) == 1 and set(at()) == {"year=2020", "year=2022"}
    N.delete_figures(spark, table)
    assert not fs.exists(spark, table)


def test_small_files_share_tasks(spark):
    """File i of several partitions goes to one task, so there are fewer tasks than files."""
    sizes = spark.createDataFrame([((1,), 5), ((2,), 3), ((3,), 1)], "_sw_key struct<year: int>, _sw_nb long")
    tasks = lambda together: {r[0][0]: (r[1], r[2]) for r in L._first_tasks(sizes, together).collect()}
    assert tasks(3) == {1: (0, 5), 2: (0, 5), 3: (0, 5)}
    assert tasks(2) == {1: (0, 5), 2: (0, 5), 3: (5, 1)}
    assert tasks(1) == {1: (0, 5), 2: (5, 3), 3: (8, 1)}
