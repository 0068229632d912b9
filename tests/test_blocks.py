"""Hot groups are cut by rank, whatever the order values look like; scratch data needs a shared folder."""

import pytest
from pyspark.sql import functions as F

from strataward import session
from strataward.functions import ordered as ordered_module
from strataward.functions.ordered import BLOCK, BUCKET, _bucketed, ordered, with_index
from strataward.functions.quantiles import key_quantiles
from strataward.functions.size import KEY, SkewPolicy, find_hot, key_column
from strataward.operators.anomaly import iqr_anomaly

SPLIT = SkewPolicy(mode="blocks", block_rows=100)

ORDERS = {
    "common prefix": lambda: F.format_string("Customer#%09d", F.col("id")),
    "one far date": lambda: F.when(F.col("id") == 0, F.lit("1900-01-01")).otherwise(F.date_format(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")), "yyyy-MM-dd")),
    "epoch seconds": lambda: F.col("id") + 1_700_000_000,
    "equal first value": lambda: F.lit(7),
    "nulls": lambda: F.when(F.col("id") % 3 > 0, F.col("id")),
}


@pytest.mark.parametrize("kind", ORDERS)
def test_buckets_are_even_for_any_order(spark, kind):
    df = spark.range(4000).select("id", F.lit("k").alias("k"), ORDERS[kind]().alias("o"))
    got = with_index(df, ["k"], ["o", "id"], policy=SPLIT)
    plain = with_index(df, ["k"], ["o", "id"], policy=SkewPolicy(mode="bounded"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    blocks = ordered(df, ["k"], ["o", "id"], halo=1, policy=SPLIT).df.groupBy(BLOCK).count().collect()
    assert len(blocks) in (40, 41) and max(r["count"] for r in blocks) <= 2 * 100
    hot = find_hot(df, ["k"], SPLIT)
    cut = _bucketed(df.withColumn(KEY, key_column(["k"])), ["o", "id"], hot, 100).groupBy(BUCKET).count().collect()
    assert len(cut) > 100 and max(r["count"] for r in cut) <= 100


def test_splitter_tree_of_a_hundred_thousand_buckets(spark, monkeypatch):
    """One key with 100 000 buckets: three levels, no row of cuts or samples over a megabyte, exact positions."""
    n = 100_000
    df = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") * 7919 % n).alias("o"))
    tables = []
    plain = ordered_module._cuts

    def watched(rows, order_by, level):
        out = plain(rows, order_by, level)
        tables.append(out)
        return out

    monkeypatch.setattr(ordered_module, "_cuts", watched)
    got = with_index(df, ["k"], ["o"], policy=SkewPolicy(mode="blocks", block_rows=4))
    assert got.where("o <> row_index").count() == 0 and got.count() == n
    assert len(tables) == 3
    for t in tables:
        assert t.agg(F.max(F.length(F.to_json("_sw_cuts")))).first()[0] < 1 << 20
        assert t.agg(F.max(F.size("_sw_cuts"))).first()[0] < 256
    hot = find_hot(df, ["k"], SkewPolicy(mode="blocks"))
    sizes = _bucketed(df.withColumn(KEY, key_column(["k"])), ["o"], hot, 4).groupBy(BUCKET).count()
    worst, number = sizes.agg(F.max("count"), F.count(F.lit(1))).first()
    assert worst <= 40 and number > n / 4


def test_splitter_tree_is_walked_once(spark):
    """Readers of the bucketed rows don't repeat the lookups of every level; types that can't be stored still work."""
    n = 3000
    df = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") * 1009 % n).alias("o"))
    hot = find_hot(df, ["k"], SkewPolicy(mode="blocks"))
    for block_rows in (4, 100):  # two levels and one
        rows = _bucketed(df.withColumn(KEY, key_column(["k"])), ["o"], hot, block_rows)
        assert rows.count() == n and "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = with_index(df.withColumn("nothing", F.lit(None)), ["k"], ["o"], policy=SkewPolicy(mode="blocks", block_rows=4))
    assert got.where("o <> row_index").count() == 0 and got.count() == n


def test_no_whole_group_statistics_where_every_group_is_split(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"), F.col("id").cast("double").alias("v"))
    flagged = iqr_anomaly(df, "v", ["k"], policy=SPLIT)
    assert "percentile(" not in flagged._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, flagged.collect())) == sorted(map(tuple, iqr_anomaly(df, "v", ["k"]).collect()))


def test_quantiles_agree_on_nan_and_infinity(spark):
    rows = [("a", float("nan")), ("a", float("inf")), ("a", 1.0), ("a", float("-inf")), ("a", 2.0), ("b", None), ("b", 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for method in ("cont", "disc"):
        plain, split = (
            {r.k: repr(tuple(r)) for r in key_quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 1.0], ["a", "b", "c", "d"], method, p).collect()}
            for p in (SkewPolicy(mode="bounded"), SPLIT)
        )
        assert plain == split


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Fake:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    with pytest.raises(RuntimeError):
        session.scratch_root(Fake(spark_master="yarn"))
    with pytest.raises(RuntimeError):
        session.scratch_root(Fake(spark_master="local-cluster[2,1,1024]"))
    assert session.scratch_root(Fake(spark_master="yarn", **{"spark.checkpoint.dir": "s3a://b/x/"})) == "s3a://b/x"
