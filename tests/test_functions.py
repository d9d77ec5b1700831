import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import columns as C


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_fix_ddate(spark):
    assert one(spark, C.fix_ddate, "29231231") == "20231231"
    assert one(spark, C.fix_ddate, "21061130") == "20161130"
    assert one(spark, C.fix_ddate, "21051130") == "20151130"
    assert one(spark, C.fix_ddate, "21080430") == "20180430"
    assert one(spark, C.fix_ddate, "20230630") == "20230630"
    assert one(spark, lambda c: C.yyyymmdd(C.fix_ddate(c)), "29231231") == dt.date(2023, 12, 31)


def test_dates(spark):
    assert one(spark, C.yyyy, "2015") == dt.date(2015, 1, 1)
    assert one(spark, C.yyyymmdd, "") is None
    assert one(spark, C.yyyymmdd, "20231301") is None  # malformed -> NULL, not an error
    assert one(spark, C.prev_year_end, dt.date(2020, 4, 30), "date") == dt.date(2019, 12, 31)


def test_parse_pair(spark):
    def pair(u):
        df = spark.createDataFrame([(u,)], "u string")
        c1, c2 = C.parse_pair(F.col("u"))
        r = df.select(c1.alias("a"), c2.alias("b"), C.base_currency(c1, c2).alias("base")).first()
        return r["a"], r["b"], r["base"]
    assert pair("EURUSD") == ("EUR", "USD", "EUR")
    assert pair("EURO/USD") == ("EUR", "USD", "EUR")
    assert pair("USD/JPY") == ("USD", "JPY", "JPY")
    assert pair("EUR") == (None, None, None)
    assert pair("USD/shares") == (None, None, None)
    # a pair without USD among the first two codes is still read as EUR->USD style
    assert pair("EURGBPUSD") == ("EUR", "GBP", "EUR")


def test_rate_to_usd(spark):
    df = spark.createDataFrame([("USD", "110"), ("EUR", "1.1"), ("USD", "0")], "c1 string, v string")
    out = [r[0] for r in df.select(C.rate_to_usd("c1", F.col("v").cast("decimal(28,4)"))).collect()]
    assert abs(out[0] - 1 / 110) < 1e-15 and out[1] == 1.1 and out[2] is None


def test_blank_and_ratio(spark):
    assert one(spark, C.blank_to_null, "") is None
    assert one(spark, C.blank_to_null, "x") == "x"
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(C.safe_ratio("a", "b")).collect()] == [None, None, 1.5]


def test_exact_mean_of_wide_sums(spark):
    from pyspark.sql import functions as F

    from ledgerlake.operators.fx import exact_mean
    cases = {"wide": [6e17, 6e17], "signs": [9.5e17, -9.5e17, 9.5e17, 1.5], "small": [0.1, 0.2, 0.3], "beyond": [6e20, 2e20],
             "nulls": [None, 2.0], "none": [None], "many": [9.9e17] * 500}
    df = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "k string, v double")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_mean(F.col("v")).alias("m")).collect()}
    assert got["wide"] == 6e17 and got["many"] == pytest.approx(9.9e17, rel=1e-15) and got["none"] is None
    assert got["signs"] == pytest.approx(9.5e17 / 4, rel=1e-15) and got["small"] == 0.2
    assert got["beyond"] == 4e20 and got["nulls"] == 2.0
