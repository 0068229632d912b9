"""Every registered query against its check SQL on the smallest tables."""

import compare
import pytest
from pyspark.sql import functions as F

from strataward.plans.queries import all_oracles, all_queries

SF = f"{compare.TESTDATA}/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    rows, problem, _ = compare.compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert problem is None, problem


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["ts_code_id", "bars", "anomalies", "mean_score"]
    assert df.count() > 0


def test_raw_keys_stay_out_of_the_range(spark, tmp_path):
    """Order keys as large as IDs: still no IDs, as the check SQL says."""
    import os

    for t in compare.TABLES:
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    (tmp_path / "orders.parquet").unlink()
    # a folder of its own, read as one table by both
    rows = spark.read.parquet(f"{SF}/orders.parquet").withColumn("o_orderkey", F.col("o_orderkey") + 999_900).toPandas()
    rows.to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us")
    name = "check_dict_consistency"
    assert compare.compare(spark, compare.duck(str(tmp_path)), name, QUERIES[name], ORACLES[name], str(tmp_path))[1] is None
