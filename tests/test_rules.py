"""Dictionaries, intervals, plans, suppression and validation: properties and edge cases."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataward.functions.size import SkewPolicy
from strataward.operators import coverage as C
from strataward.operators import cross
from strataward.operators import dictionary as D
from strataward.operators import monitor as M
from strataward.operators import planning as P
from strataward.operators import repair as R
from strataward.operators import revision as V
from strataward.operators import score as S
from strataward.operators import suppression as X
from strataward.operators import watermark as W
from strataward.plans import flow
from strataward.streaming.alerts import suppress_stream

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def codes(spark, values):
    return spark.createDataFrame([(v,) for v in values], "code string")


# -- dictionaries


@QUICK
@given(st.lists(st.text("abcXYZ01", min_size=1, max_size=4), min_size=1), st.lists(st.text("abcXYZ01", min_size=1, max_size=4), min_size=1))
def test_ids_are_permanent_unique_and_in_range(spark, first, second):
    one = D.allocate_ids(D.empty_dictionary(spark), codes(spark, first), "industry")
    before = {r["code"]: r["id"] for r in one.collect()}
    stored = spark.createDataFrame(list(before.items()), "code string, id long")
    after = {r["code"]: r["id"] for r in D.allocate_ids(stored, codes(spark, second), "industry").collect()}
    assert set(after) == set(first) | set(second)
    assert all(after[c] == i for c, i in before.items())
    assert sorted(after.values()) == list(range(2_000_000, 2_000_000 + len(after)))


def test_last_id_is_usable_and_the_next_raises(spark):
    small = {"stock": (1, 3)}
    full = D.allocate_ids(D.empty_dictionary(spark), codes(spark, ["a", "b", "c"]), "stock", small)
    assert sorted(r["id"] for r in full.collect()) == [1, 2, 3]
    with pytest.raises(PySparkException, match="exhausted"):
        D.allocate_ids(D.empty_dictionary(spark), codes(spark, "abcd"), "stock", small).collect()


def test_encode_decode(spark):
    known = spark.createDataFrame([("000001.SZ", 1_000_001), ("600000.SH", 1_000_002)], "code string, id long")
    facts = spark.createDataFrame([("000001.SZ", 1.0), ("new", 2.0), (None, 3.0)], "ts_code string, close double")
    coded = D.encode(facts, known, "ts_code")
    assert {r["close"]: r["ts_code_id"] for r in coded.collect()} == {1.0: 1_000_001, 2.0: None, 3.0: None}
    with pytest.raises(PySparkException, match="no ID"):
        D.encode(facts, known, "ts_code", on_missing="error").collect()
    synced, grown = D.sync_encode(facts, known, "ts_code", "stock")
    assert {r["close"]: r["ts_code_id"] for r in synced.collect()} == {1.0: 1_000_001, 2.0: 1_000_003, 3.0: None}
    back = D.decode(synced.drop("ts_code"), known, "ts_code_id")
    assert {r["close"]: r["ts_code"] for r in back.collect()} == {1.0: "000001.SZ", 2.0: "stock_id_1000003", 3.0: None}
    assert grown.count() == 3


def test_versions(spark, tmp_path):
    store = f"file://{tmp_path}/versions"
    one = spark.createDataFrame([("a", 1_000_000)], "code string, id long")
    two = spark.createDataFrame([("b", 1_000_001), ("a", 1_000_000)], "code string, id long")
    first = D.version_dict(one, store, "stock", "t1")
    D.version_dict(two, store, "stock", "t2")
    assert D.current_dict(spark, store, "stock").count() == 2
    assert D.rollback_dict(spark, store, "stock", first, "t3").count() == 1
    assert D.current_dict(spark, store, "stock").collect() == one.collect()
    assert [r["action"] for r in D.version_history(spark, store, "stock").collect()] == ["create", "create", "rollback"]
    assert D.content_hash(two).collect() == D.content_hash(two.orderBy("id")).collect() != D.content_hash(one).collect()
    with pytest.raises(ValueError):
        D.rollback_dict(spark, store, "stock", "none", "t4")
    assert D.current_dict(spark, store, "region").count() == 0


# -- intervals and plans


def brute_union(spans):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


@QUICK
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12)), min_size=1, max_size=30))
def test_merge_periods_is_the_union(spark, raw):
    base = dt.date(2024, 1, 1)
    spans = [(a, a + n) for a, n in raw]
    day = lambda i: base + dt.timedelta(days=i)
    df = spark.createDataFrame([("k", day(a), day(b)) for a, b in spans], "k string, period_start date, period_end date")
    got = sorted(((r[1] - base).days, (r[2] - base).days) for r in C.merge_periods(df, ["k"]).collect())
    assert got == brute_union(spans)


def bars(spark, days):
    return spark.createDataFrame([(c, d) for c, ds in days.items() for d in ds], "ts_code string, trade_date string")


def test_one_day_hole_and_weekends(spark):
    df = bars(spark, {"a": ["20240105", "20240108", "20240110"], "b": ["20240101", None]})
    plain = [tuple(r)[2:] for r in C.find_gaps(df, "d", "ts_code", "trade_date").orderBy("gap_start").collect()]
    assert plain == [(dt.date(2024, 1, 6), dt.date(2024, 1, 7), 2), (dt.date(2024, 1, 9), dt.date(2024, 1, 9), 1)]
    from strataward.functions.dates import weekday_calendar

    cal = weekday_calendar(spark, "2024-01-01", "2024-01-31")
    assert [tuple(r)[2:] for r in C.find_gaps(df, "d", "ts_code", "trade_date", cal).collect()] == [(dt.date(2024, 1, 9), dt.date(2024, 1, 9), 1)]
    cov = {r["code"]: r for r in C.coverage(df, "d", "ts_code", "trade_date").collect()}
    assert (cov["a"]["gap_count"], cov["b"]["invalid_dates"], cov["b"]["record_count"]) == (2, 1, 2)


def test_load_decisions(spark):
    df = bars(spark, {"full": ["20240101", "20240102"], "gap": ["20240101", "20240103"], "bad": ["x"], "late": ["20240102"],
                      "flawed": ["20240101", "20240102", "x"]})
    cov = C.coverage(df, "d", "ts_code", "trade_date")
    universe = codes(spark, ["full", "gap", "bad", "late", "flawed", "none"])
    got = {r["code"]: (r["action"], r["reason"]) for r in P.plan_loads(cov, universe, "d", "20240101", "20240102").collect()}
    assert got == {
        "full": ("skip", "data_fully_covered_and_complete"), "gap": ("full", "data_gaps_detected"), "bad": ("full", "invalid_date_range"),
        "late": ("missing", "missing_data_periods"), "none": ("full", "no_existing_data"),
        "flawed": ("skip", "data_incomplete_but_no_missing_periods"),
    }
    gaps = C.find_gaps(df, "d", "ts_code", "trade_date")
    plan = P.plan_loads(cov, universe, "d", "20240101", "20240105", "missing", gaps)
    periods = sorted((str(r["period_start"]), str(r["period_end"])) for r in plan.where("code = 'gap'").collect())
    assert periods == [("2024-01-02", "2024-01-02"), ("2024-01-04", "2024-01-05")]
    with pytest.raises(ValueError):
        P.plan_loads(cov, universe, "d", "20240101", "20240105", "missing")


def test_tasks_by_strategy(spark):
    from strataward.sources.catalog import DatasetSpec

    run = lambda s, **kw: P.expand_tasks(spark, DatasetSpec("x", "x", batch_strategy=s, batch_size=2), "20240101", "20240704", **kw)
    assert run("by_date").count() == 186
    assert [str(r["period_start"]) for r in run("by_period").collect()] == ["2024-03-31", "2024-06-30"]
    assert sorted(r["unit"] for r in run("by_exchange").collect()) == ["SSE", "SZSE"]
    assert run("by_month").count() == run("by_date_range").count() == 1
    tasks = run("by_stock", codes=codes(spark, ["c", "a", "b"])).orderBy("unit").collect()
    assert [(r["unit"], r["batch_no"]) for r in tasks] == [("a", 0), ("b", 0), ("c", 1)]
    with pytest.raises(ValueError):
        run("by_stock")


# -- suppression


def brute_emit(times, window):
    last, keep = None, []
    for i, t in enumerate(times):
        if last is None or t - last >= window:
            keep.append(i)
            last = t
    return keep


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=60), st.integers(1, 60))
def test_positions_by_brute_force(raw, window):
    times = np.array(sorted(raw))
    assert X.emitted_positions(times, window) == brute_emit(sorted(raw), window)


def alerts(spark, n=800, seed=3):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (f"a{i:05d}", "t", "hot" if rnd.random() < 0.4 else rnd.choice("abc"), "high", start + dt.timedelta(minutes=rnd.randint(0, 6000)))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "alert_id string, alert_type string, dataset string, severity string, ts timestamp_ntz"), rows


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(mode="blocks")])
def test_suppression_by_brute_force(spark, policy):
    df, rows = alerts(spark)
    want = set()
    for k in {r[2] for r in rows}:
        group = sorted((r[4], r[0]) for r in rows if r[2] == k)
        minutes = [int((t - dt.datetime(2024, 1, 1)).total_seconds() // 60) for t, _ in group]
        want |= {group[i][1] for i in brute_emit(minutes, 30)}
    assert {r["alert_id"] for r in X.suppress_alerts(df, policy=policy, block_rows=7).collect()} == want


def test_stream_keeps_state_between_batches(spark, tmp_path):
    df, _ = alerts(spark, 200)
    base = f"file://{tmp_path}"
    cut = F.lit("2024-01-03").cast("timestamp_ntz")

    def run():
        source = spark.readStream.schema(df.schema).parquet(f"{base}/in")
        (suppress_stream(source).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
         .trigger(availableNow=True).start().awaitTermination())

    df.where(F.col("ts") < cut).write.mode("append").parquet(f"{base}/in")
    run()
    df.where(F.col("ts") >= cut).write.mode("append").parquet(f"{base}/in")
    run()
    got = {r["alert_id"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {r["alert_id"] for r in X.suppress_alerts(df).collect()}


def test_stream_state_ends(spark, tmp_path):
    """The state of a key is gone once the watermark has passed the window of its last emission."""
    base = f"file://{tmp_path}"
    fields = "alert_id string, alert_type string, dataset string, severity string, ts timestamp, note string"
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)

    def run(*rows):
        spark.createDataFrame([(i, "t", d, "high", ts, f"n{i}") for i, d, ts in rows], fields).coalesce(1).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(fields).parquet(f"{base}/in")
        (suppress_stream(source).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
         .trigger(availableNow=True).start().awaitTermination())
        return spark.read.format("statestore").option("path", f"{base}/cp").option("stateVarName", "last_us").load().count()

    assert run(("1", "a", at(10)), ("2", "b", at(10, 5)), ("3", "a", at(10, 12))) == 2
    assert run(("4", "c", at(10, 50)), ("5", "a", at(10, 31))) == 2  # b's window ends at 10:35, a's moves to 11:01
    assert run(("6", "d", at(12)), ("7", "x", None)) == 1
    got = {r["alert_id"]: r["note"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {i: f"n{i}" for i in "124567"}


def test_stream_groups_do_not_grow_with_keys(spark, tmp_path):
    """Sixty keys in three groups of the worker; each key's chain and state end as if it were alone."""
    base = f"file://{tmp_path}"
    fields = "alert_id string, alert_type string, dataset string, severity string, ts timestamp"
    start = dt.datetime(2024, 1, 1)
    rows = [(f"a{i}", "t", f"d{i * 7 % 60}", "high", start + dt.timedelta(minutes=i * 37 % 600)) for i in range(1200)]
    rows.sort(key=lambda r: r[4])

    def run(part):
        spark.createDataFrame(part, fields).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(fields).parquet(f"{base}/in")
        (suppress_stream(source, buckets=3).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
         .trigger(availableNow=True).start().awaitTermination())
        return spark.read.format("statestore").option("path", f"{base}/cp").option("stateVarName", "last_us").load()

    run(rows[:700])
    state = run(rows[700:])
    assert state.select("key").distinct().count() <= 3
    got = spark.read.parquet(f"{base}/out")
    assert {r["alert_id"] for r in got.collect()} == {r["alert_id"] for r in X.suppress_alerts(spark.createDataFrame(rows, fields)).collect()}
    last = got.groupBy("dataset").agg(F.max("ts").alias("ts"))
    open_keys = last.where(F.col("ts") >= F.lit(rows[-1][4] - dt.timedelta(minutes=40)))  # window and lateness
    assert 0 < state.count() == open_keys.count() < 60


def test_stored_alerts_are_facts(spark, tmp_path):
    """Stored 10:00, late 09:40, then 10:12: the last is 12 minutes after an emitted alert."""
    from strataward.operators import ledger

    path = f"file://{tmp_path}/alerts"
    for i, (h, m) in enumerate([(10, 0), (9, 40), (10, 12), (10, 30)]):
        row = [(f"a{i}", "t", "d", "high", dt.datetime(2024, 1, 1, h, m))]
        ledger.raise_alerts(spark.createDataFrame(row, "alert_id string, alert_type string, dataset string, severity string, ts timestamp_ntz"), path)
    assert sorted(r["alert_id"] for r in ledger.load_rows(spark, path).collect()) == ["a0", "a1", "a3"]
    plan = ledger.load_rows(spark, path, "2024-01-01", "2024-01-02")._jdf.queryExecution().toString()
    assert "day#" in plan.split("PartitionFilters")[1][:200]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=50, unique=True), st.integers(1, 80), st.integers(1, 9))
def test_block_runs_carry_the_chain(raw, window, size):
    """Blocks of any size, put together by their runs, emit what one pass emits."""
    times = sorted(raw)
    rows = [("k", X.NEVER, b, e, x) for b in range(-(-len(times) // size)) for e, x in X.block_runs(np.array(times[b * size : (b + 1) * size]), window)]
    batch = X._batch(rows, ("_key", "_seed", "_block", "entry", "leave"))
    carry = [r for out in X._carries(window)(iter([batch])) for r in out.to_pylist()]
    got = []
    for r in carry:
        own = np.array(times[r["_block"] * size : (r["_block"] + 1) * size])
        got += [int(own[i]) for i in X.emitted_positions(own, window, r["_carry"])]
    assert got == [times[i] for i in brute_emit(times, window)]


# -- validation, revisions, scores


def test_revision_classes(spark):
    new = spark.createDataFrame([("a", "q1", 100.0), ("b", "q1", 102.0), ("c", "q1", 5.0), ("d", "q1", 1.0), ("e", "q1", None)], "ts_code string, end_date string, v double")
    old = spark.createDataFrame([("a", "q1", 90.0), ("b", "q1", 100.0), ("c", "q1", 0.0), ("e", "q1", None), ("z", "q1", 1.0)], "ts_code string, end_date string, v double")
    got = {r["ts_code"]: (r["change_pct"], r["abs_change"]) for r in V.detect_revisions(new, old).collect()}
    assert got == {"a": (pytest.approx(1 / 9), 10.0), "c": (float("inf"), 5.0)}
    s = V.revision_stats(new, old).first()
    assert tuple(s) == (5, 2, 1, 1, 1)
    assert V.unchanged_records(new, old).first()["ts_code"] == "e"
    assert V.new_records(new, old.limit(0)).count() == 5


def test_cross_checks_need_two_datasets_and_common_codes(spark):
    a, b = codes(spark, "ab").withColumnRenamed("code", "ts_code"), codes(spark, "bc").withColumnRenamed("code", "ts_code")
    assert cross.check_code_consistency({"x": a}).count() == 0
    got = {(r["dataset"], r["entity"]) for r in cross.check_code_consistency({"x": a, "y": b}).collect()}
    assert got == {("y", "a"), ("x", "c")}
    assert cross.check_code_consistency({"x": a, "y": codes(spark, "z")}).count() == 0
    with pytest.raises(ValueError):
        cross.check_references(a, b, "x", "nope")


@pytest.mark.parametrize("check, want", [("required_field_null", "critical"), ("price_anomaly", "high"), ("price_bounds", "medium"), ("ohlc_high", "low")])
def test_severity(spark, check, want):
    assert spark.range(1).select(S.issue_severity(F.lit(check))).first()[0] == want


@pytest.mark.parametrize("issues, records, want", [(0, 0, 1.0), (1, 0, 0.0), (5, 100, 0.95), (300, 100, 0.0)])
def test_score(spark, issues, records, want):
    assert spark.range(1).select(S.quality_score(F.lit(issues), F.lit(records))).first()[0] == want


def test_trend_of_one_point_and_counts(spark):
    rows = [("a", "2024-01-01", 0.5, 9), ("a", "2024-01-02", 0.9, 3), ("b", "2024-01-02", 0.5, 1)]
    h = spark.createDataFrame(rows, "dataset string, d string, quality_score double, total_issues int").withColumn("ts", F.col("d").cast("timestamp_ntz"))
    trend = lambda **kw: {r["dataset"]: r["trend"] for r in M.quality_trends(h, "2024-01-03", 7, **kw).collect()}
    assert trend()["a"] == "improving" and trend()["b"] == "insufficient_data"
    assert trend(value="total_issues", higher_is_better=False)["a"] == "improving"
    assert trend(value="total_issues")["a"] == "degrading"


def test_confidence(spark):
    faults = spark.createDataFrame([("nulls", 10.0, "medium"), ("duplicates", 2.0, "high")], "issue string, percentage double, severity string")
    assert R.repair_confidence(faults).first()["confidence"] == pytest.approx((0.9 + 0.95) / 2)
    assert R.repair_confidence(faults, ()).first()["confidence"] == pytest.approx(1 - 5 / 6)
    assert R.repair_confidence(faults.limit(0)).first()["confidence"] == 1.0


def test_repair_rules_run_last(spark):
    df = spark.createDataFrame([("a", "20240101", 1.0), ("a", "20240102", None)], "k string, d string, close double")
    config = R.RepairConfig(repairs=("nulls",), rules={"double": lambda x: x.withColumn("close", F.col("close") * 2)})
    out, faults = R.repair_dataset(df, ["d"], ["k"], config=config)
    assert [r["close"] for r in out.orderBy("d").collect()] == [2.0, 2.0]
    assert faults.where("issue = 'nulls'").first()["count"] == 1


def test_flow_with_history(spark):
    df = spark.createDataFrame([("a", "20240331", 2.0), ("a", "20240331", 2.0)], "ts_code string, end_date string, revenue double")
    result = flow.quality_flow({"income": df}, {"income": "financial"}, "2024-12-31", historical=df.limit(1))
    assert {r["check"] for r in result.issues.collect()} == {"duplicate_financial_entry"}
    assert result.scores.first()["quality_score"] == 0.5
    assert result.revisions.first()["unchanged_records"] == 2


def test_watermark_update_keeps_other_fields(spark):
    now = lambda d: F.lit(d).cast("timestamp_ntz")
    up = spark.createDataFrame([("x", 10)], "dataset string, record_count long")
    first = up.withColumns({"last_update_date": F.lit("2024-01-01").cast("date"), "updated_at": now("2024-01-01")})
    later = up.withColumns({"record_count": F.lit(None).cast("long"), "last_update_date": F.lit("2024-01-05").cast("date"), "updated_at": now("2024-01-05")})
    row = W.merge_watermarks(W.merge_watermarks(W.empty_watermarks(spark), first), later).first()
    assert (row["record_count"], str(row["last_update_date"]), str(row["created_at"])[:10]) == (10, "2024-01-05", "2024-01-01")


def test_tied_rows_have_one_order(spark):
    """Rows that the order leaves equal: as many steps and anomalies whatever way the rows come in."""
    from strataward.operators import consistency as C
    from strataward.plans import flow

    closes = [1.0, 1.1, 5.0, 1.0, 9.0, 5.1, 1.2, 9.1]
    fields = "ts_code string, trade_date string, open double, close double, volume long"
    rows = [(f"k{k}", None, 2.0, closes[(i * (k + 1)) % 8], i) for k in range(4) for i in range(8)]
    found = set()
    for part in (rows, rows[::-1], sorted(rows, key=lambda r: (r[0], -r[3]))):
        df = spark.createDataFrame(part, fields).coalesce(1)
        steps = C.check_price_change(df, "d", ["trade_date", "open"], ["ts_code"]).first()["count"]
        odd = flow.anomaly_issues(df, "d", ["trade_date", "open"], ["ts_code"]).collect()
        found.add((steps, tuple(r["count"] for r in odd)))
    assert len(found) == 1
