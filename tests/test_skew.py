"""A filing that holds a third of all facts and a firm with many filings:
results stay exact and the plan reduces the hot keys before any exchange."""

import random

from pyspark.sql import functions as F

from conftest import num_row, sub_row
from ledgerlake.plans.models import FilingModels


def _fixture(raw_fixture):
    rnd = random.Random(11)
    subs = [sub_row("HOT", cik="1")] + [sub_row(f"F{i}", cik=str(1 + i % 3)) for i in range(40)]
    nums = []
    dates = ["20201231", "20191231", "20200930"]
    for i in range(1200):  # the hot filing
        nums.append(num_row("HOT", rnd.choice(["Assets", "Cash", "Revenues", "SharesOutstanding", "SharePrice"]),
                            rnd.choice(dates), str(rnd.randint(1, 10**6)),
                            uom=rnd.choice(["USD", "EURUSD", "shares"]), qtrs=rnd.choice(["0", "4"])))
    for i in range(40):
        for _ in range(50):
            nums.append(num_row(f"F{i}", rnd.choice(["Assets", "Revenues", "LongTermDebt"]), rnd.choice(dates),
                                str(rnd.randint(1, 10**6)), uom=rnd.choice(["USD", "GBP/USD"]),
                                qtrs=rnd.choice(["0", "4"])))
    return raw_fixture(subs, nums), nums


def test_hot_filing_exact(spark, raw_fixture):
    raw, nums = _fixture(raw_fixture)
    m = FilingModels(spark, raw)
    got = {(r.adsh, r.ddate.isoformat(), r.uom): float(r.assets) for r in m.metric_view("assets", "usd").collect()}
    want = {}
    for n in nums:
        if n["tag"] == "Assets" and n["qtrs"] == "0" and n["uom"] == "USD" and float(n["value"]) > 0:
            d = n["ddate"]
            k = (n["adsh"], f"{d[:4]}-{d[4:6]}-{d[6:]}", "USD")
            want[k] = max(want.get(k, 0.0), float(n["value"]))
    assert got == want


def test_partial_aggregation_before_exchange(spark, raw_fixture):
    raw, _ = _fixture(raw_fixture)
    m = FilingModels(spark, raw)
    df = m.metric_values
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(metric" in ln
          and "adsh" in ln and "cik" in ln]
    assert ex, "the metric aggregate shuffles on its keys"
    # the exchange after the facts join sits on a partial (map-side) aggregate
    assert "partial_max" in lines[ex[0] + 1]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top1_limit_runs_before_shuffle(spark, raw_fixture):
    raw, _ = _fixture(raw_fixture)
    m = FilingModels(spark, raw)
    df = m.float_latest
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(cik" in ln]
    assert ex, "top-1 per company shuffles on cik"
    # a partial per-task limit sits directly under the shuffle: a hot company
    # sends one row per task across the exchange, not all of its facts
    assert "WindowGroupLimit" in lines[ex[0] + 1]
    assert m.float_latest.groupBy("cik").count().filter(F.col("count") > 1).count() == 0


def test_copies_of_a_quarter_do_not_multiply_facts(spark, raw_fixture):
    """The same filing landed three times (append mode): metric maxima and the
    facts feeding every model are unchanged."""
    subs = [sub_row("A1", cik="1")]
    nums = [num_row("A1", "Assets", "20201231", "100"), num_row("A1", "Assets", "20201231", "70")]
    once = FilingModels(spark, raw_fixture(subs, nums))
    thrice = FilingModels(spark, raw_fixture(subs * 3, nums))
    assert thrice.facts.count() == once.facts.count() == 2
    assert [r.assets for r in thrice.metric_view("assets", "usd").collect()] == [100]
    assert thrice.stg_num.count() == 6  # the staging view keeps the source's multiplicity
