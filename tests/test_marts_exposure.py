"""Float inference, financials, exposure and KPIs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import num_row, sub_row
from ledgerlake.operators import exposure, kpis
from ledgerlake.plans.models import FilingModels


def test_float_candidates_coreg_pairing(spark, raw_fixture):
    subs = [sub_row("A1"), sub_row("A2", cik="2")]
    nums = [num_row("A1", "SharesOutstanding", "20201231", "100", uom="shares"),
            num_row("A1", "SharesOutstanding", "20201231", "120", uom="shares"),
            num_row("A1", "SharePrice", "20201231", "5", uom="USD/shares"),
            num_row("A1", "SharePrice", "20201231", "7", uom="USD/shares"),
            num_row("A1", "SharePrice", "20211231", "9", uom="USD/shares"),  # no shares that day
            num_row("A2", "SharesOutstanding", "20201231", "10", uom="shares"),
            num_row("A2", "SharePrice", "20201231", "3", uom="USD/shares", coreg="SUB")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    c = m.float_candidates.collect()
    assert len(c) == 1 and c[0].adsh == "A1" and c[0].value == 840.0 and c[0].uom == "shares"
    assert c[0].tag == "ComputedMarketFloat" and c[0].srcdir == "computed" and c[0].qtrs == 0


def test_float_candidates_match_all_pairs(spark, raw_fixture):
    """Per-key reduction equals ranking every share x price pair (brute force)."""
    rnd = random.Random(7)
    subs = [sub_row(f"A{i}", cik=str(i)) for i in range(6)]
    nums = []
    for i in range(6):
        for _ in range(8):
            d = rnd.choice(["20201231", "20210331"])
            co = rnd.choice(["", "SUB"])
            if rnd.random() < 0.5:
                nums.append(num_row(f"A{i}", "SharesOutstanding", d, str(rnd.randint(1, 4) * 10),
                                    uom=rnd.choice(["shares", "sh"]), coreg=co))
            else:
                nums.append(num_row(f"A{i}", "SharePrice", d, str(rnd.randint(1, 4)), uom="USD/shares", coreg=co))
    m = FilingModels(spark, raw_fixture(subs, nums))
    got = {r.adsh: (r.ddate, r.value, r.uom, r.coreg) for r in m.float_candidates.collect()}
    facts = m.facts.collect()
    sh = [f for f in facts if f.tag == "SharesOutstanding"]
    pr = [f for f in facts if f.tag == "SharePrice"]
    want = {}
    for a in {f.adsh for f in facts}:
        pairs = [(s, p) for s, p in itertools.product(sh, pr) if s.adsh == a == p.adsh and s.ddate == p.ddate
                 and (s.coreg or "__") == (p.coreg or "__")]
        if not pairs:
            continue
        best = sorted(pairs, key=lambda sp: (-sp[0].ddate.toordinal(), -sp[0].value, -sp[1].value,
                                             sp[0].coreg or "", sp[0].uom))[0]
        s, p = best
        want[a] = (s.ddate, float(s.value) * float(p.value), s.uom, s.coreg)
    assert got == want


def test_financials_fanout_and_dedupe(spark, raw_fixture):
    subs = [sub_row("R1", cik="1"), sub_row("R2", cik="1", form="20-F")]
    nums = [num_row("R1", "Revenues", "20201231", "500", qtrs="4"),
            num_row("R1", "Assets", "20201231", "1000")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    fin = m.financials().collect()
    assert len(fin) == 2  # one revenue row x two annual filings of the firm-year
    assert all(r.assets_usd == 1000.0 and r.revenue_usd == 500.0 for r in fin)
    assert m.financials(dedupe=True).count() == 1


def test_float_latest_nulls_first(spark, raw_fixture):
    subs = [sub_row("A1", cik="1"), sub_row("A2", cik="1")]
    nums = [num_row("A1", "EntityPublicFloat", "20201231", "100"),
            num_row("A2", "EntityPublicFloat", "", "50")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    r = m.float_latest.collect()
    assert len(r) == 1 and r[0].latest_float_value_usd == 50.0 and r[0].last_ddate is None


def test_exposure_factorised_equals_pairs(spark):
    rnd = random.Random(3)
    esg = [(rnd.randint(1, 6), rnd.choice([None, rnd.random()]), 2019 + rnd.randint(0, 2)) for _ in range(40)]
    assets = [(rnd.randint(1, 8), rnd.choice([10, 11, 12]), float(rnd.randint(1, 100))) for _ in range(60)]
    e = spark.createDataFrame(esg, "cik long, ph_expo_ew double, year int")
    a = spark.createDataFrame(assets, "cik long, sic int, assets double")
    got = {r.industry_code: (r.asset_weighted_physical_climate_change_exposure, r.firm_count)
           for r in exposure.asset_weighted_exposure(e, a).collect()}
    pairs = [(ec, x, sic, av) for ec, x, _ in esg for ac, sic, av in assets if ec == ac and x is not None and av > 0]
    want = {}
    for sic in {p[2] for p in pairs}:
        ps = [p for p in pairs if p[2] == sic]
        want[sic] = (sum(p[1] * p[3] for p in ps) / sum(p[3] for p in ps), len({p[0] for p in ps}))
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], rel=1e-12) and got[k][1] == want[k][1]


def test_exposure_two_years_two_assets(spark):
    e = spark.createDataFrame([(1, 0.1, 2019), (1, 0.3, 2020)], "cik long, ph_expo_ew double, year int")
    a = spark.createDataFrame([(1, 10, 100.0), (1, 10, 300.0)], "cik long, sic int, assets double")
    r = exposure.asset_weighted_exposure(e, a).first()
    assert r.asset_weighted_physical_climate_change_exposure == pytest.approx(0.2) and r.firm_count == 1


def test_kpi_zero_and_null_denominators(spark):
    fin = spark.createDataFrame(
        [("A", 1, None, None, 1, 0.0, 5.0, 10.0, 0.0, 2.0, 50.0)],
        "name string, cik long, fy date, ddate date, sic int, revenue_usd double, income_usd double, "
        "market_cap_usd double, debt_usd double, cash_usd double, assets_usd double")
    r = kpis.ratio_kpis(fin).first()
    assert r.profit_margin is None and r.cash_ratio is None and r.return_on_assets_roa == 0.1
    rel = kpis.relative_kpis(kpis.ratio_kpis(fin)).first()
    assert rel.relative_return_on_assets_roa == pytest.approx(1.0)


def test_daily_totals(spark):
    o = spark.createDataFrame([("2020-01-01 10:00:00", 1.5), ("2020-01-01 23:00:00", 2.0),
                               ("2020-01-02 00:00:00", 4.0)], "ts string, amount double") \
             .withColumn("ts", F.to_timestamp("ts"))
    out = {str(r.order_date): r.total_amount for r in exposure.daily_totals(o, "ts", "amount").collect()}
    assert out == {"2020-01-01": 3.5, "2020-01-02": 4.0}


def test_exposure_match_year_option(spark):
    import datetime as dt
    e = spark.createDataFrame([(1, 0.1, 2019), (1, 0.3, 2020)], "cik long, ph_expo_ew double, year int")
    a = spark.createDataFrame([(1, 10, 100.0, dt.date(2019, 1, 1)), (1, 10, 300.0, dt.date(2020, 1, 1))],
                              "cik long, sic int, assets double, fy date")
    r = exposure.asset_weighted_exposure(e, a, match_year=True).first()
    assert r.asset_weighted_physical_climate_change_exposure == pytest.approx((0.1 * 100 + 0.3 * 300) / 400)


def test_uom_mode_pair_or_single(spark, raw_fixture):
    subs = [sub_row("X2", cik="3"), sub_row("R", cik="9")]
    nums = [num_row("X2", "Assets", "20201231", "70", uom="EUR"),
            num_row("R", "ClosingForeignExchangeRate", "20201231", "2", uom="EURUSD")]
    raw = raw_fixture(subs, nums)
    assert FilingModels(spark, raw).t("assets").count() == 0
    out = FilingModels(spark, raw, uom_mode="pair_or_single").t("assets").collect()
    assert len(out) == 1 and out[0].assets_usd == 140.0


def test_rejects_and_strict(spark, raw_fixture):
    from ledgerlake.operators.staging import RejectedRowsError
    subs = [sub_row("A1", cik="x12")]
    nums = [num_row("A1", "Assets", "2020-12-31", "12,5"), num_row("A1", "Assets", "20201231", "3")]
    m = FilingModels(spark, raw_fixture(subs, nums))
    assert [r.rejected_columns for r in m.rejects_num.collect()] == [["ddate", "value"]]
    assert [r.rejected_columns for r in m.rejects_sub.collect()] == [["cik"]]
    with pytest.raises(RejectedRowsError):
        FilingModels(spark, raw_fixture(subs, nums), strict=True).stg_sub


def test_relative_kpis_match_window_semantics(spark):
    """Industry means joined back null-safely equal window averages (a NULL
    industry is its own group)."""
    import datetime as dt
    from pyspark.sql import Window
    rows = [("A", 1, dt.date(2020, 1, 1), None, 1, 10.0, 2.0, 5.0, 1.0, 3.0, 20.0),
            ("B", 2, dt.date(2020, 1, 1), None, 1, 20.0, 1.0, 5.0, 2.0, 1.0, 10.0),
            ("C", 3, dt.date(2020, 1, 1), None, None, 30.0, 3.0, 5.0, 4.0, 2.0, 30.0),
            ("D", 4, dt.date(2021, 1, 1), None, 1, 40.0, 8.0, 5.0, 0.0, 5.0, 40.0)]
    fin = spark.createDataFrame(rows, "name string, cik long, fy date, ddate date, sic int, revenue_usd double, "
                                "income_usd double, market_cap_usd double, debt_usd double, cash_usd double, "
                                "assets_usd double")
    kp = kpis.ratio_kpis(fin)
    got = {r.cik: r for r in kpis.relative_kpis(kp).collect()}
    want = kp
    for name, (base, keys) in kpis.RELATIVE.items():
        want = want.withColumn(name, F.try_divide(F.col(base), F.avg(base).over(Window.partitionBy(*keys))))
    for r in want.collect():
        for name in kpis.RELATIVE:
            a, b = got[r.cik][name], r[name]
            assert (a is None and b is None) or a == pytest.approx(b), (r.cik, name)


def test_eighteen_kpis_by_hand(spark):
    """Each KPI of one firm worked out by hand beside a second firm of its industry."""
    import datetime as dt
    day, fy = dt.date(2020, 12, 31), dt.date(2020, 1, 1)
    fin = spark.createDataFrame(
        [("A", 1, fy, day, 7, 100.0, 20.0, 400.0, 50.0, 25.0, 200.0),
         ("B", 2, fy, day, 7, 200.0, 10.0, 100.0, 100.0, 150.0, 400.0)],
        "name string, cik long, fy date, ddate date, sic int, revenue_usd double, income_usd double, "
        "market_cap_usd double, debt_usd double, cash_usd double, assets_usd double")
    esg = spark.createDataFrame([(1, 2020, 0.5, 0.25, 0.1, 0.2)], "cik long, year int, cc_risk_ew double, "
                                "op_expo_ew double, cc_expo_ew double, ph_risk_ew double")
    a = {r.cik: r for r in kpis.all_kpis(fin, esg).collect()}[1].asDict()
    want = {"profit_margin": 0.2, "return_on_assets_roa": 0.1, "debt_to_assets_ratio": 0.25,
            "market_cap_to_revenue": 4.0, "cash_ratio": 0.5, "asset_turnover_ratio": 0.5,
            "cash_to_assets_ratio": 0.125, "income_to_market_cap_ratio": 0.05, "revenue_to_assets_ratio": 0.5,
            "debt_to_revenue_ratio": 0.5, "relative_profit_margin": 1.6, "relative_return_on_assets_roa": 1.6,
            "relative_debt_ratio": 1.0, "liquidity_index": 0.5, "revenue_per_climate_risk": 200.0,
            "market_cap_per_esg_opportunity": 1600.0, "profit_margin_per_climate_exposure": 2.0,
            "cash_resilience_to_physical_risk": 125.0}
    assert set(want) == set(kpis.KPI_COLS)
    assert {k: a[k] for k in want} == pytest.approx(want)
