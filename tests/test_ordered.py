"""Split plans against whole-group plans and brute force, with a key that holds most rows."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataward.functions.ordered import ordered, with_index
from strataward.functions import quantiles
from strataward.functions.quantiles import key_quantiles, order_code
from strataward.functions.size import BOUNDED, SkewPolicy, empty_frame, find_hot, input_bytes
from strataward.operators import anomaly as A
from strataward.operators import repair as R

BLOCKS = SkewPolicy(mode="blocks", block_rows=16)
MIXED = SkewPolicy(small_bytes=0, max_group_rows=40, block_rows=40)


def _rows(n=600, seed=1):
    """A third of all rows in one key, a burst in time, a null key, nulls and repeated values."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice([None, "a", "b", "c", "d", "e"])
        at = rnd.choice([rnd.uniform(0, 1000), 500 + rnd.random() / 1e6])
        value = None if rnd.random() < 0.2 else rnd.choice([0.0, -1.5, *[rnd.gauss(50, 10)] * 6, 400.0 if i % 20 == 1 else 50.0])
        out.append((key, at, i, value, float(rnd.randint(1, 9))))
    return out


@pytest.fixture(scope="module")
def series(spark):
    return spark.createDataFrame(_rows(), "k string, t double, seq int, value double, volume double").repartition(3)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("policy", [BLOCKS, MIXED])
def test_index_is_exact(series, keys, policy):
    got = {r["seq"]: r["row_index"] for r in with_index(series, keys, ["t", "seq"], policy=policy).collect()}
    want = {r["seq"]: r["row_index"] for r in with_index(series, keys, ["t", "seq"], policy=BOUNDED).collect()}
    assert got == want and len(got) == 600


@pytest.mark.parametrize("policy", [BLOCKS, MIXED])
def test_fill_and_lag(series, policy):
    def run(p):
        o = ordered(series, ["k"], ["t", "seq"], fill=["value"], halo=3, policy=p)
        d = o.df.withColumns({"f": o.filled("value"), "back": F.lag("volume", 3).over(o.window)})
        return sorted(map(tuple, o.finish(d).select("seq", "f", "back").collect()))

    assert run(policy) == run(BOUNDED)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("policy", [BLOCKS, MIXED])
def test_anomalies_agree(series, keys, policy):
    config = A.AnomalyConfig(volatility_threshold=0.2)
    rows = lambda p: sorted(
        map(tuple, A.detect_anomalies(series, "value", ["t", "seq"], keys, "volume", config, p).drop("k", "t", "value").collect())
    )
    got, want = rows(policy), rows(BOUNDED)
    assert got == want
    assert any(r[-2] for r in want)


def test_anomaly_flags_by_hand(spark):
    values = [10.0, 11.0, 10.5, 10.2, 99.0, 10.1, None]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in enumerate(values)], "t int, v double, vol double")
    got = {r["t"]: r for r in A.detect_anomalies(df, "v", ["t"], volume="vol").collect()}
    assert [got[i]["iqr_anomaly"] for i in range(7)] == [False, False, False, False, True, False, False]
    assert got[6]["zscore_anomaly"] is None and got[0]["price_gap_anomaly"] is None
    assert got[4]["anomaly_score"] == 0.25 and got[4]["is_anomaly"] is True
    assert got[0]["is_anomaly"] is None  # false or unknown
    with pytest.raises(ValueError):
        A.detect_anomalies(df, "nope", ["t"])


@pytest.mark.parametrize("method", ["cont", "disc"])
@pytest.mark.parametrize("policy", [BLOCKS, MIXED, BOUNDED])
def test_quantiles_by_brute_force(series, method, policy):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r[0]: list(r)[1:] for r in key_quantiles(series, ["k"], "value", probs, list("abcdef"), method, policy).collect()}
    groups = {}
    for k, _, _, v, _ in _rows():
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    kind = "linear" if method == "cont" else "inverted_cdf"
    for k, values in groups.items():
        assert got[k] == pytest.approx([float(np.quantile(values, p, method=kind)) for p in probs], abs=1e-9)


def test_order_code_is_the_order_of_doubles(spark):
    rng = np.random.default_rng(5)
    any_bits = rng.integers(-(2**63), 2**63, 3000, dtype=np.int64).view(np.float64)
    powers = [s * f * 2.0**e for e in range(-1074, 1024, 7) for f in (1.0, 1 - 2**-53, 1 + 2**-52) for s in (1, -1)]
    plain = [v for v in [*any_bits.tolist(), *powers, 0.0, -0.0, 5e-324, float("inf"), float("-inf")] if v == v]
    got = {r[0]: r[1] for r in spark.createDataFrame([(v,) for v in plain], "v double").select("v", order_code(F.col("v"))).collect()}
    for v, code in got.items():
        bits = int(np.float64(abs(v)).view(np.int64))
        assert code == (bits if v >= 0 else -bits)
    nan = spark.range(1).select(order_code(F.lit(float("nan")))).first()[0]
    assert nan > max(got.values())


@pytest.mark.parametrize("kind", ["epoch", "constant", "two values", "shared prefix"])
def test_rank_buckets_stay_small(spark, kind, monkeypatch):
    """Hot key with values of one or two leading digits: no bucket over the limit is ever ranked in a task."""
    n = 20_000
    value = {
        "epoch": F.col("id") + 1_700_000_000, "constant": F.lit(3.25), "two values": F.when(F.col("id") % 3 == 0, 1.0).otherwise(1.0 + 2**-52),
        "shared prefix": 1.0 + F.col("id") * 2.0**-50,
    }[kind].cast("double")
    df = spark.range(n).select(F.lit("k").alias("k"), value.alias("v"))
    sizes = []
    plain = quantiles._narrowed

    def watched(*a):
        out = plain(*a)
        sizes.append(out)
        return out

    monkeypatch.setattr(quantiles, "_narrowed", watched)
    probs, names = [0.0, 0.25, 0.5, 1.0], list("abcd")
    got = key_quantiles(df, ["k"], "v", probs, names, policy=SkewPolicy(mode="blocks", block_rows=500)).first()
    want = np.quantile(np.array([r[0] for r in df.select("v").collect()]), probs)
    assert [got[c] for c in names] == pytest.approx(list(want), abs=0, rel=1e-15)
    last = sizes[-1].where("_low <> _high").agg(F.max("_n")).first()[0]
    assert last is None or last <= 500
    assert kind != "constant" or len(sizes) == 1


def test_policy_measures(series, spark):
    assert find_hot(series, ["k"], SkewPolicy()) is None
    assert find_hot(series, ["k"], SkewPolicy(small_bytes=0, max_group_rows=150)).count == 1
    assert find_hot(series, ["k"], SkewPolicy(small_bytes=0, max_group_rows=1000)) is None
    assert input_bytes(empty_frame(spark, "a int")) < 100


@pytest.mark.parametrize("policy", [BLOCKS, MIXED])
def test_ffill_and_gap_repair(series, spark, policy):
    rows = lambda p: sorted(map(tuple, R.repair_ffill(series, ["value"], ["t", "seq"], ["k"], p).drop("k").collect()), key=lambda r: r[1])
    assert rows(policy) == rows(BOUNDED)
    days = spark.createDataFrame([("a", "20240101", 1.0), ("a", "20240105", 5.0), ("b", "20240103", None), ("b", "20240105", 2.0)], "k string, d string, v double")
    got = sorted(map(tuple, R.repair_gaps(days, "d", ["v"], ["k"], policy=policy).collect()))
    assert got[:5] == [("a", f"2024010{i}", float(i), 1 < i < 5) for i in range(1, 6)]
    assert got[6] == ("b", "20240104", None, True)


def test_winsorize_and_statistics(spark):
    values = [float(v) for v in range(1, 21)] + [1000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bounds = R.outlier_bounds(df).first()
    q1, _, q3 = statistics.quantiles(values, n=4, method="inclusive")
    assert bounds["upper"] == pytest.approx(q3 + 1.5 * (q3 - q1))
    assert R.repair_winsorize(df, R.outlier_bounds(df)).agg(F.max("v")).first()[0] == pytest.approx(bounds["upper"])


def test_order_code_is_computed_once_a_row(spark):
    """Filters and keys on the code refer to it; none of them computes it again."""
    coded = spark.range(10).select(order_code(F.col("id").cast("double")).alias("c"))
    used = coded.withColumn("b", F.shiftright("c", 40)).where(F.col("b").isNotNull() & (F.col("c") > 3)).groupBy("c", "b").count()
    plan = used._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_code(") == 1 and "POWER" not in plan.upper()
    assert used.count() == 9  # all but zero
