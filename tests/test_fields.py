"""Names, dates, partition columns and numbers on literal rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from strataward.functions import dates, text
from strataward.operators import normalize as N
from strataward.sources import catalog as C


def test_catalog_counts():
    kinds = [s.granularity for s in C.CATALOG.values()]
    assert (len(kinds), kinds.count("YEAR"), kinds.count("YEAR_MONTH"), kinds.count("NONE")) == (39, 13, 4, 22)


@pytest.mark.parametrize(
    "name, layout", [("income", "NONE"), ("daily", "YEAR"), ("block_trade", "YEAR_MONTH"), ("forecast", "NONE"), ("unknown", "NONE")]
)
def test_select_strategy(name, layout):
    assert C.select_strategy(name) == layout


def test_alias_is_used_once_and_canonical_wins():
    assert N.alias_map(["date", "code"]) == {"date": "trade_date", "code": "ts_code"}
    assert N.alias_map(["date", "ann_dt"]) == {"date": "trade_date", "ann_dt": "ann_date"}
    assert N.alias_map(["trade_date", "tradedate"]) == {}
    # a date beside a trade date is an announcement date
    assert N.alias_map(["trade_date", "date"]) == {"date": "ann_date"}


def test_date_int_replaces_all_separators(spark):
    df = spark.createDataFrame([("2023-01-15",), ("2023/02/16",), ("20230317",), ("bad",), (None,)], "trade_date string")
    got = [r[1] for r in N.add_date_int(df, "trade_date").collect()]
    assert got == [20230115, 20230216, 20230317, None, None]


def test_invalid_year_gives_null_partition(spark):
    df = spark.createDataFrame([("000001.SZ", "invalid_date", "invalid_year")], "ts_code string, trade_date string, year string")
    row = N.normalize(df, C.dataset("daily")).first()
    assert row["trade_date_int"] is None and row["year"] is None


def test_missing_partition_field_fails(spark):
    df = spark.createDataFrame([("000001.SZ", "x")], "ts_code string, other string")
    with pytest.raises(ValueError, match="partition"):
        N.normalize(df, C.dataset("daily"))
    with pytest.raises(ValueError):
        N.add_partition_cols(df, "trade_date", C.YEAR)


def test_numbers_with_separators(spark):
    df = spark.createDataFrame([("1,234,567", "x", 3)], "open string, close string, volume int")
    row = N.coerce_numeric(df).first()
    assert (row["open"], row["close"], row["volume"]) == (1234567.0, None, 3)


@pytest.mark.parametrize(
    "raw, want",
    [
        ("20231028", (2023, 10, 28)), ("2023-10-28", (2023, 10, 28)), ("2023/1/8", (2023, 1, 8)), ("2023-10", (2023, 10, 1)),
        ("202306", (2023, 6, 30)), ("202312", (2023, 12, 31)), ("202305", None), ("20231340", None), (" 20231028 ", (2023, 10, 28)), ("x", None),
    ],
)
def test_parse_date(spark, raw, want):
    got = spark.range(1).select(dates.parse_date(F.lit(raw))).first()[0]
    assert got == (datetime.date(*want) if want else None)


@pytest.mark.parametrize(
    "path, code",
    [
        ("/d/000001_SZ.parquet", "000001.SZ"), ("/d/SZ000001.parquet", "000001.SZ"), ("/d/000001.SZ.parquet", "000001.SZ"),
        ("/d/600000.parquet", "600000.SH"), ("/d/300001.parquet", "300001.SZ"), ("/d/800001.parquet", "800001.SH"),
        ("/d/year=2023/ts_code=000001.SZ/data.parquet", "000001.SZ"), ("/d/data.parquet", None),
    ],
)
def test_code_from_path(spark, path, code):
    assert spark.range(1).select(text.code_from_path(F.lit(path))).first()[0] == code


def test_periods_and_days(spark):
    got = [str(r[0]) for r in dates.report_periods(spark, "2023-03-31", "2023-12-30").collect()]
    assert got == ["2023-03-31", "2023-06-30", "2023-09-30"]
    assert dates.business_days(spark, "2024-01-05", "2024-01-08").count() == 4
    calendar = dates.weekday_calendar(spark, "2024-01-01", "2024-01-31")
    assert dates.business_days(spark, "2024-01-05", "2024-01-08", calendar).count() == 2


def test_find_date_column():
    assert dates.find_date_column(["close", "ann_date"]) == "ann_date"
    assert dates.find_date_column(["close"]) is None
