"""Hand-written cases for staging, FX, metric extraction and conversion (FIXTURES.md section 4)."""

import datetime as dt

import pytest

from conftest import num_row, sub_row
from ledgerlake.functions.tags import METRICS
from ledgerlake.operators import metrics
from ledgerlake.plans.models import FilingModels

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stg_sub_drops_blank_fy_and_period(spark, raw_fixture):
    raw = raw_fixture([sub_row("A1"), sub_row("A2", fy=""), sub_row("A3", period="")], [])
    m = FilingModels(spark, raw)
    assert [r.adsh for r in m.stg_sub.collect()] == ["A1"]
    r = m.stg_sub.first()
    assert r.cik == 1 and r.fy == D(2020, 1, 1) and r.period == D(2020, 12, 31) and r.wksi is True
    assert r.ein is None and r.accepted_raw is None


def test_stg_num_keeps_fy_filings_only(spark, raw_fixture):
    raw = raw_fixture(
        [sub_row("A1"), sub_row("Q2", fp="Q2")],
        [num_row("A1", "Assets", "29231231", ""), num_row("Q2", "Assets", "20201231", "5"),
         num_row("NOFILING", "Assets", "20201231", "5")])
    m = FilingModels(spark, raw)
    out = m.stg_num.collect()
    assert len(out) == 1
    assert out[0].adsh == "A1" and out[0].ddate == D(2023, 12, 31) and out[0].value is None
    assert out[0].coreg is None and out[0].fy == D(2020, 1, 1) and out[0].fp == "FY"


def test_fx_pairs_and_average(spark, raw_fixture):
    subs = [sub_row("A1")]
    nums = [num_row("A1", "ClosingForeignExchangeRate", "20201231", "1.10", uom="EURUSD"),
            num_row("A1", "ClosingForeignExchangeRate", "20201231", "1.20", uom="EURUSD"),
            num_row("A1", "ClosingForeignExchangeRate", "20201231", "110", uom="USD/JPY"),
            num_row("A1", "ClosingForeignExchangeRate", "20201231", "1.1", uom="EUR"),
            num_row("A1", "ClosingForeignExchangeRate", "20161231", "1.1", uom="GBP/USD"),
            num_row("A1", "AverageForeignExchangeRate", "20201231", "1.3", uom="GBP/USD", qtrs="4")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    c = {r.base: r for r in m.closing_fx.collect()}
    assert set(c) == {"EUR", "JPY"}  # bare EUR has no pair; 2016 is before the FX window
    assert c["EUR"].to_usd == pytest.approx(1.15) and c["EUR"].from_usd == pytest.approx(1 / 1.15)
    assert c["JPY"].to_usd == pytest.approx(1 / 110)
    a = m.average_fx.collect()
    assert len(a) == 1 and a[0].base == "GBP" and a[0].to_usd == pytest.approx(1.3)


def _two_filings(spark, raw_fixture):
    subs = [sub_row("U1", cik="1"), sub_row("X1", cik="2"), sub_row("X2", cik="3"),
            sub_row("OLD", cik="4", fy="2013"), sub_row("Q", cik="5", form="10-Q")]
    nums = [
        # USD and EURUSD assets -> only the USD view; two USD facts -> max
        num_row("U1", "Assets", "20201231", "100"), num_row("U1", "Assets", "20201231", "150"),
        num_row("U1", "Assets", "20201231", "90", uom="EURUSD"),
        num_row("U1", "Assets", "20191231", "-5"),  # negative assets dropped
        # Only EURUSD
        num_row("X1", "Assets", "20201231", "80", uom="EURUSD"),
        # Bare EUR assets (row disappears from t_a), bare EUR revenue (NULL row in t_r)
        num_row("X2", "Assets", "20201231", "70", uom="EUR"),
        num_row("X2", "Revenues", "20201231", "60", uom="EUR", qtrs="4"),
        # negative income kept
        num_row("U1", "NetIncomeLoss", "20201231", "-12", qtrs="4"),
        num_row("OLD", "Assets", "20201231", "1"), num_row("Q", "Assets", "20201231", "1"),
        num_row("U1", "Assets", "20201231", "7", coreg="SUB"),
        num_row("U1", "ClosingForeignExchangeRate", "20201231", "1.25", uom="EURUSD"),
    ]
    return FilingModels(spark, raw_fixture(subs, nums))


def test_metric_views(spark, raw_fixture):
    m = _two_filings(spark, raw_fixture)
    assert rows(m.metric_view("assets", "usd"), "adsh", "assets") == [("U1", 150)]
    assert rows(m.metric_view("assets", "xyz"), "adsh", "uom") == [("X1", "EURUSD"), ("X2", "EUR")]
    assert rows(m.metric_view("income", "usd"), "adsh", "income") == [("U1", -12)]


def test_single_pass_equals_per_metric(spark, raw_fixture):
    m = _two_filings(spark, raw_fixture)
    for spec in METRICS.values():
        for cur in ("usd", "xyz"):
            single_pass = metrics.metric_view(m.metric_values, spec.name, cur)
            per_metric = metrics.metric_view_direct(m.facts, spec, cur)
            narrow = m.metric_view(spec.name, cur)  # only this metric's tags read
            for a, b in ((single_pass, per_metric), (single_pass, narrow)):
                assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_conversion_and_no_match(spark, raw_fixture):
    m = _two_filings(spark, raw_fixture)
    ta = rows(m.t("assets"), "adsh", "assets_usd")
    assert ta == [("U1", 150.0), ("X1", pytest.approx(100.0))]  # X2 (bare EUR) dropped
    tr = rows(m.t("revenue"), "adsh", "revenue_usd")
    assert tr == [("X2", None)]  # kept with NULL


@pytest.mark.parametrize("rate_date,tag,qtrs,expect", [
    ("20200229", "ClosingForeignExchangeRate", "0", 2.0),        # t - 2 months (end of Feb)
    ("20200430", "AverageForeignExchangeRate", "4", 3.0),        # average at t
    ("20191231", "AverageForeignExchangeRate", "4", 4.0),        # average at previous 31 Dec
    ("20190430", "AverageForeignExchangeRate", "4", 5.0),        # average at t - 1 year
    ("20200331", "ClosingForeignExchangeRate", "0", None),       # t - 1 month is 03-30: not found
])
def test_fx_fallback_steps(spark, raw_fixture, rate_date, tag, qtrs, expect):
    rate = {2.0: "2", 3.0: "3", 4.0: "4", 5.0: "5", None: "9"}[expect]
    subs = [sub_row("X1", cik="2"), sub_row("R", cik="9")]
    nums = [num_row("X1", "Assets", "20200430", "10", uom="EURUSD"),
            num_row("R", tag, rate_date, rate, uom="EURUSD", qtrs=qtrs)]
    m = FilingModels(spark, raw_fixture(subs, nums))
    out = rows(m.t("assets"), "adsh", "assets_usd")
    assert out == [("X1", None if expect is None else pytest.approx(10 * expect))]


def test_usd_and_converted_rows_per_firm_year(spark, raw_fixture):
    subs = [sub_row("U1", cik="1"), sub_row("X1", cik="1", period="20201231")]
    nums = [num_row("U1", "Assets", "20201231", "100"),
            num_row("X1", "Assets", "20201231", "10", uom="EURUSD"),
            num_row("X1", "ClosingForeignExchangeRate", "20201231", "2", uom="EURUSD")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    assert rows(m.t("assets"), "adsh", "assets_usd") == [("U1", 100.0), ("X1", 20.0)]


def test_top1_null_ddate_first(spark, raw_fixture):
    subs = [sub_row("A1", cik="1"), sub_row("A2", cik="1")]
    nums = [num_row("A1", "Assets", "20201231", "100"), num_row("A2", "Assets", "bad", "50")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    assert rows(m.t("assets"), "adsh", "assets_usd") == [("A2", 50.0)]


def test_exact_mean_is_order_independent(spark):
    import random
    from pyspark.sql import functions as F
    from ledgerlake.operators.fx import exact_mean
    vals = [0.1, 0.2, 0.3, 1 / 3, 1 / 7, 1.1, 2.2, 1e-9, 123.456]
    results = set()
    for seed in range(4):
        rnd = random.Random(seed)
        shuffled = vals[:]
        rnd.shuffle(shuffled)
        df = spark.createDataFrame([(v,) for v in shuffled], "r double").repartition(1 + seed)
        results.add(df.agg(exact_mean(F.col("r")).alias("m")).first().m)
    assert len(results) == 1
    assert abs(results.pop() - sum(vals) / len(vals)) < 1e-12


def test_top1_ties_break_on_adsh(spark, raw_fixture):
    subs = [sub_row("B2", cik="1"), sub_row("A9", cik="1")]
    nums = [num_row("B2", "Assets", "20201231", "100"), num_row("A9", "Assets", "20201231", "50")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    assert rows(m.t("assets"), "adsh", "assets_usd") == [("A9", 50.0)]
