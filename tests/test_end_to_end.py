"""Archives -> landing -> models gives the same marts as the direct raw tables."""

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from ledgerlake.plans.models import FilingModels  # noqa: E402
from ledgerlake.sources.adapter import DriverRaw  # noqa: E402
from ledgerlake.sources.landing import LandedRaw, land_archives  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_landed_archives_give_same_financials(spark):
    from make_archives import write_archives
    root = tempfile.mkdtemp(prefix="ll-e2e-")
    zips = os.path.join(root, "zips")
    write_archives(spark, SF, zips)
    written = land_archives(spark, zips, os.path.join(root, "raw"), mode="replace")
    direct = DriverRaw(spark, SF)
    assert written["sub"] == sorted(r.srcdir for r in direct.sub.select("srcdir").distinct().collect())
    assert written["tag"] == ["2020q1"]
    landed = LandedRaw(spark, os.path.join(root, "raw"),
                       seeds={"esg_risk_factors": direct.esg_risk_factors, "isin_cik": direct.isin_cik})
    assert landed.num.count() == direct.num.count() and landed.sub.count() == direct.sub.count()
    a = FilingModels(spark, direct).financials()
    b = FilingModels(spark, landed).financials().select(*a.columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cli_build_writes_every_model(spark):
    import csv
    from make_archives import write_archives
    from ledgerlake.__main__ import _models, build_all
    root = tempfile.mkdtemp(prefix="ll-cli-")
    write_archives(spark, SF, os.path.join(root, "zips"))
    land_archives(spark, os.path.join(root, "zips"), os.path.join(root, "raw"), mode="append")
    direct = DriverRaw(spark, SF)
    seeds = os.path.join(root, "seeds")
    os.makedirs(seeds)
    for name, df in (("esg_risk_factors", direct.esg_risk_factors), ("isin_cik", direct.isin_cik)):
        rows = df.collect()  # tiny seed tables written as CSV files for the test
        with open(os.path.join(seeds, f"{name}.csv"), "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(df.columns)
            w.writerows([["" if v is None else v for v in r] for r in rows])
    m = _models(spark, os.path.join(root, "raw"), seeds)
    written = build_all(m, os.path.join(root, "out"))
    m.release()
    assert {"financials", "t_a", "float", "kpis", "asset_weighted_phys_climate_exposure_view"} <= set(written)
    fin = spark.read.parquet(os.path.join(root, "out", "financials"))
    assert fin.count() == FilingModels(spark, direct).financials().count()
    expo = spark.read.parquet(os.path.join(root, "out", "asset_weighted_phys_climate_exposure_view"))
    assert expo.count() == FilingModels(spark, direct).exposure().count()
