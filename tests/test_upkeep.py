"""Upkeep of the t_* tables and the financials by what a landing changed, against full builds."""

import os
import shutil
import tempfile
import zipfile

import pytest
from conftest import NUM_COLS, SUB_COLS, num_row, sub_row
from pyspark.sql import functions as F

from ledgerlake.functions.tags import FX_CLOSING_TAGS, METRICS
from ledgerlake.plans import upkeep
from ledgerlake.plans.models import FilingModels
from ledgerlake.plans.upkeep import UpkeptTables
from ledgerlake.sources import landing, landing_log


def table_text(rows, cols):
    cols = [c for c in cols if c != "srcdir"]
    return "\n".join(["\t".join(cols), *("\t".join(r.get(c) or "" for c in cols) for r in rows)]) + "\n"


def land(spark, root, mode="append", **quarters):
    at = tempfile.mkdtemp(prefix="ll-upkeep-")
    for quarter, (subs, nums) in quarters.items():
        with zipfile.ZipFile(os.path.join(at, f"{quarter}.zip"), "w") as z:
            z.writestr("sub.txt", table_text(subs, SUB_COLS))
            z.writestr("num.txt", table_text(nums, NUM_COLS))
    landing.land_archives(spark, at, root, mode=mode)


def figures(adsh, year, scale, uom="USD"):
    """Facts of all six metrics of a filing."""
    out = []
    for k, spec in enumerate(METRICS.values()):
        out.append(num_row(adsh, spec.tags[0], f"{year}1231", str(scale + k), uom=uom, qtrs=str(spec.qtrs)))
    return out


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def equal_to_full_build(spark, raw_root, upkept):
    full = FilingModels(spark, landing.LandedRaw(spark, raw_root))
    want, money = full.converted_table, full.financials()
    assert plain(upkept.amounts().select(*want.columns)) == plain(want)
    assert plain(upkept.financials().select(*money.columns)) == plain(money)
    full.release()
    return upkept.financials().count()


def rate(adsh, day, value, uom="EURUSD"):
    return num_row(adsh, FX_CLOSING_TAGS[0], day, value, uom=uom)


@pytest.fixture
def roots():
    at = tempfile.mkdtemp(prefix="ll-upkeep-root-")
    return f"{at}/raw", f"{at}/kept"


Q1 = ([sub_row("A1", cik="1"), sub_row("A2", cik="2"), sub_row("A3", cik="3"), sub_row("A4", cik="")],
      figures("A1", 2020, 10) + figures("A2", 2020, 20, uom="EURUSD") + figures("A3", 2020, 30) + figures("A4", 2020, 40)
      + [rate("A1", "20201231", "1.25")])
#: A later filing of firm 1 for the same year, a first one of firm 5, and a second quote of the rate that firm 2 uses.
Q2 = ([sub_row("B1", cik="1"), sub_row("B5", cik="5", fy="2021")],
      figures("B1", 2021, 100) + figures("B5", 2021, 50) + [rate("B5", "20201231", "1.75")])


def test_every_landing_leaves_what_a_full_build_gives(spark, roots, monkeypatch):
    raw, kept = roots
    tables = UpkeptTables(spark, raw, kept, buckets=4)
    assert tables.refresh() is not None and tables.amounts().count() == 0  # nothing landed yet
    land(spark, raw, **{"2021q1": Q1})
    first = tables.refresh()
    assert first.srcdirs == ("2021q1",) and first.years == (2020,)
    assert {r.cik: r.assets_usd for r in tables.t("assets").collect()}[2] == pytest.approx(20 * 1.25)
    assert tables.refresh() is None
    old = plain(tables.financials())
    assert len(old) == 3

    # a refresh that dies leaves the old tables
    land(spark, raw, **{"2021q2": Q2})
    monkeypatch.setattr(upkeep.marts, "financials", killed)
    with pytest.raises(RuntimeError):
        tables.refresh()
    monkeypatch.undo()
    assert plain(tables.financials()) == old

    # the facts of the first quarter are not read again: they are out of reach now
    (folder,) = [d for d in landing_log.read_state(spark, raw).dirs("num") if d.endswith("q1")]
    aside = tempfile.mkdtemp(prefix="ll-upkeep-aside-") + "/q1"
    shutil.move(f"{raw}/{folder}", aside)
    os.makedirs(f"{raw}/{folder}")
    second = tables.refresh()
    shutil.copytree(aside, f"{raw}/{folder}", dirs_exist_ok=True)
    assert second.srcdirs == ("2021q2",) and second.years == (2020, 2021)
    assert equal_to_full_build(spark, raw, tables) >= 4
    amounts = {(r.cik, r.fy.year): r.assets_usd for r in tables.t("assets").collect()}
    assert amounts[(2, 2020)] == pytest.approx(20 * 1.5)  # not landed again, but its rate has moved
    assert amounts[(1, 2020)] == 100.0 and amounts[(3, 2020)] == 30.0

    # firm 3 has gone, A1 is another firm's, A2 reports dollars; the other quarter's members are empty
    land(spark, raw, "replace", **{"2021q2": ([], []), "2021q1": (
        [sub_row("A1", cik="7"), sub_row("A2", cik="2"), sub_row("A2", cik="2", form="10-K/A")],
        figures("A1", 2020, 11) + figures("A2", 2020, 21))})
    tables.refresh()
    equal_to_full_build(spark, raw, tables)
    assert {r.cik for r in tables.t("assets").collect()} == {2, 7}


def killed(*a, **k):
    raise RuntimeError("killed")


def test_rates_are_looked_up_once_per_unit_and_date(spark, roots, monkeypatch):
    """Not once per amount: the lookups of a refresh are units x dates, whatever the number of filings."""
    raw, kept = roots
    n = 12
    land(spark, raw, **{"2021q1": ([sub_row(f"A{k}", cik=str(k)) for k in range(n)],
                                   [f for k in range(n) for f in figures(f"A{k}", 2020, 10 + k, uom="EURUSD" if k % 2 else "EUR")]
                                   + [rate("A0", "20201130", "1.25"), rate("A0", "20191231", "1.5", uom="USD/JPY")])})
    asked = []

    def candidates(df, only=None):
        asked.append(df.count())
        return found(df, only)
    found = upkeep.convert.fx_candidates
    monkeypatch.setattr(upkeep.convert, "fx_candidates", candidates)
    tables = UpkeptTables(spark, raw, kept, buckets=4)
    tables.refresh()
    monkeypatch.undo()
    assert asked and max(asked) == 1
    assert equal_to_full_build(spark, raw, tables) == n
    assert {r.cik: r.debt_usd for r in tables.t("debt").collect()}[1] is not None


def test_amounts_by_known_lookups(spark):
    """As by seven lookups a row, with and without a broadcast; dates and units that no rate answers stay without one."""
    days = ["2020-12-31", "2020-11-30", "2021-03-31", "2021-06-30", "2019-05-05", None]
    units = ["USD", "EURUSD", "USD/JPY", "EUR", "GBP/USD"]
    values = spark.createDataFrame(
        [(m, f"A{k}", k, "n", 1, "2020-01-01", day, unit, float(k + 1)) for m in ("assets", "debt")
         for k, (day, unit) in enumerate((d, u) for d in days for u in units)],
        "metric string, adsh string, cik long, name string, sic int, fy string, ddate string, uom string, value double")
    values = values.withColumns({c: F.to_date(c) for c in ("fy", "ddate")}).withColumn("value", F.col("value").cast("decimal(28,4)"))
    values = values.withColumn("has_usd", F.col("uom") == "USD")
    rates = spark.createDataFrame([("closing", "EUR", "2020-11-30", 1.1), ("closing", "EUR", "2020-12-31", 1.2),
                                   ("average", "JPY", "2020-12-31", 0.01), ("average", "JPY", "2019-12-31", 0.02)],
                                  "kind string, base string, ddate string, to_usd double").withColumn("ddate", F.to_date("ddate"))
    lookups = UpkeptTables._lookups(values).select("base", "ddate")
    want = plain(upkeep.convert.converted_tables(values, rates))
    assert sum(r[-1] is not None for r in want) > 12
    for most in (0, 1000):
        assert plain(upkeep.convert.converted_tables(values, rates, lookups=lookups, max_broadcast_rows=most)) == want


def test_rejects_are_counted_by_the_job_that_builds_the_model(spark, raw_fixture):
    subs = [sub_row("A1", cik="x12"), sub_row("A2", fy="20x0", period="2020-01-01")]
    nums = [num_row("A1", "Assets", "2020-12-31", "12,5"), num_row("A1", "Assets", "20201231", "3", qtrs="q"),
            num_row("A1", "Assets", "", "")]
    m = FilingModels(spark, raw_fixture(subs, nums), count_rejects=True)
    m.stg_num.write.format("noop").mode("overwrite").save()
    counts = m.reject_counts()
    assert counts["num"] == {"n_rows": 3, "ddate": 1, "qtrs": 1, "value": 1}
    assert counts["sub"] == {"n_rows": 2, "cik": 1, "sic": 0, "ein": 0, "period": 1, "fy": 1, "filed": 0}
    with pytest.raises(ValueError):
        m.assert_none_rejected()
    clean = FilingModels(spark, raw_fixture([sub_row("A1")], [num_row("A1", "Assets", "20201231", "3")]), count_rejects=True)
    clean.stg_num.write.format("noop").mode("overwrite").save()
    clean.assert_none_rejected()
    assert FilingModels(spark, raw_fixture(subs, nums)).reject_counts() == {}
