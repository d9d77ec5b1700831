
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.tags import METRICS
from ledgerlake.plans.models import FilingModels
from ledgerlake.plans.views import register_models

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def models(spark):
    return FilingModels.from_driver(spark, SF)


def test_t_tables_at_most_two_rows_per_firm_year(models):
    for name in METRICS:
        worst = models.t(name).groupBy("cik", "fy").count().agg(F.max("count")).first()[0]
        assert worst <= 2, name


def test_fx_unique_per_base_and_date(models):
    for df in (models.closing_fx, models.average_fx):
        assert df.count() == df.select("base", "ddate").distinct().count()


def test_esg_year_not_null(models):
    assert models.stg_esg.filter(F.col("year").isNull()).count() == 0


def expected_non_usd(subs, nums, spec):
    """The rule over plain rows: of annual filings without any USD value of the metric,
    the largest value per filing, date and unit."""
    import datetime
    annual = [f for f in subs if f["form"] in ("10-K", "20-F", "40-F") and f["fy"] and f["fy"] >= datetime.date(2014, 1, 1)]
    fits = {}
    for x in nums:
        if x["tag"] in spec.tags and x["qtrs"] == spec.qtrs and x["coreg"] is None and not (
                spec.positive and not (x["value"] is not None and x["value"] > 0)):
            fits.setdefault(x["adsh"], []).append(x)
    out = {}
    for f in annual:
        found = fits.get(f["adsh"], [])
        if any(x["uom"] == "USD" for x in found):
            continue
        for x in found:
            if x["uom"] is not None:
                key = (f["adsh"], f["cik"], f["name"], f["sic"], f["fy"], x["ddate"], x["uom"])
                old = out.get(key)
                out[key] = x["value"] if old is None else old if x["value"] is None else max(old, x["value"])
    return sorted(((*k, v) for k, v in out.items()), key=repr)


def test_non_usd_views_follow_the_rule(models):
    subs = [r.asDict() for r in models.stg_sub.collect()]
    nums = [r.asDict() for r in models.stg_num.collect()]
    for spec in METRICS.values():
        ours = sorted((tuple(r) for r in models.metric_view(spec.name, "xyz").collect()), key=repr)
        assert ours == expected_non_usd(subs, nums, spec), spec.name


def test_registered_source_names_answer_sql(spark, models):
    names = register_models(models)
    assert {"stg_dera_sub", "assets_usd", "fy_income_fx", "t_r", "financials", "float"} <= set(names)
    assert spark.sql("select count(*) from financials").first()[0] == models.financials().count()


def test_bucketed_layout_joins_without_exchange(spark):
    from ledgerlake.sources.adapter import DriverRaw
    raw = DriverRaw(spark, SF, buckets=4)
    m = FilingModels(spark, raw)
    df = m.metric_values
    plain = FilingModels.from_driver(spark, SF).metric_values
    assert df.exceptAll(plain).count() == 0 and plain.exceptAll(df).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from ledgerlake.operators import staging
        facts = staging.stg_num(raw.num, m.stg_sub, with_filing=True, max_broadcast_rows=None)
        facts.collect()
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(adsh" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_read_seed(spark, tmp_path):
    from ledgerlake.sources.seeds import read_seed
    p = tmp_path / "isin_cik.csv"
    p.write_text("isin,cik\nUS0000000001,0000000001\n")
    r = read_seed(spark, str(p), "isin_cik").first()
    assert r.isin == "US0000000001" and r.cik == "0000000001"


def test_no_broadcast_fallback_gives_same_results(spark, models):
    """Every size-checked broadcast has a shuffle-join path beyond its limit."""
    want = {k: [tuple(r) for r in df.collect()] for k, df in
            [("converted", models.converted), ("float", models.float_latest), ("kpis", models.kpis()),
             ("stg_num", models.stg_num)]}
    spark.catalog.clearCache()  # no cached plan (built with broadcasts) may be reused
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = FilingModels.from_driver(spark, SF, max_broadcast_rows=0)
        for k, a in [("converted", big.converted), ("float", big.float_latest), ("kpis", big.kpis()),
                     ("stg_num", big.stg_num)]:
            got = [tuple(r) for r in a.collect()]
            plan = a._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" not in plan, k
            def norm(t):  # sums may associate differently under another plan
                return tuple(float(f"{x:.12g}") if isinstance(x, float) else x for x in t)
            key = lambda t: tuple((x is None, str(x)) for x in t)
            assert sorted(map(norm, got), key=key) == sorted(map(norm, want[k]), key=key), k
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sql_over_source_view_names(spark, models):
    """SQL written against the published view names gives the operator results."""
    register_models(models)
    by_sql = spark.sql("""
        with pairs as (
          select a.sic, r.cik, double(a.assets) as weight, r.ph_expo_ew as score
          from assets_usd a, stg_esg_risk_factors r
          where a.cik = r.cik and a.assets > 0 and r.ph_expo_ew is not null)
        select sic as industry_code, try_divide(sum(weight * score), sum(weight))
                 as asset_weighted_physical_climate_change_exposure,
               size(collect_set(cik)) as firm_count
        from pairs group by sic""")
    ours = {r.industry_code: r for r in models.exposure().collect()}
    got = {r.industry_code: r for r in by_sql.collect()}
    assert set(ours) == set(got)
    for k, r in got.items():
        assert r.firm_count == ours[k].firm_count
        assert abs(r.asset_weighted_physical_climate_change_exposure
                   - ours[k].asset_weighted_physical_climate_change_exposure) < 1e-12
    top = spark.sql("select cik, count(*) as n from `float` group by cik having count(*) > 1")
    assert top.count() == 0


def test_models_as_catalog_tables(spark, models):
    from ledgerlake.plans.views import save_models_as_tables
    names = save_models_as_tables(models, base="ll_test")
    assert "ll_test_marts.financials" in names and "ll_test_stg.stg_dera_sub" in names
    n = spark.sql("select count(*) from ll_test_marts.financials").first()[0]
    assert n == models.financials().count()
    assert spark.sql("select count(*) from ll_test.t_a").first()[0] == models.t("assets").count()


def test_save_view_table_and_cluster_conf(spark, models):
    from ledgerlake.plans.views import save_table, save_view
    from ledgerlake.session import cluster_conf
    from ledgerlake.operators.staging import annual_filings
    v = save_view(annual_filings(models.stg_sub), "annual_filings_v")
    assert spark.table("annual_filings_v").count() == v.count() > 0
    t = save_table(spark, models.t("assets"), "t_a_saved")
    assert spark.table("t_a_saved").count() == t.count() == models.t("assets").count()
    conf = cluster_conf(100 * 10**12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 16000
