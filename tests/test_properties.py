"""Property tests: Spark expressions against plain-Python statements of the rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import columns as C
from ledgerlake.sources import landing

field = st.text(alphabet=st.sampled_from(list("ab\"' x1")), max_size=4)


def py_normalize(parts, n):
    if len(parts) < n:
        return parts + [""] * (n - len(parts))
    if len(parts) > n:
        return parts[: n - 1] + ["\t".join(parts[n - 1:])]
    return parts


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.lists(field, min_size=1, max_size=8), st.integers(1, 6)), min_size=1, max_size=30))
def test_normalize_fields_matches_rule(spark, cases):
    rows = [("\t".join(p), n) for p, n in cases]
    df = spark.createDataFrame(rows, "line string, n int")
    got = [r[0] for r in df.select(landing.normalize_fields(landing.split_fields(F.col("line")), F.col("n"))).collect()]
    want = [py_normalize(line.split("\t"), n) for line, n in rows]
    assert got == want


PAIR = re.compile(r"([A-Z]{3}).*?([A-Z]{3})")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("EURSDJPYGB/-x ")), max_size=10), min_size=1, max_size=30))
def test_parse_pair_matches_regex(spark, units):
    df = spark.createDataFrame([(u,) for u in units], "u string")
    c1, c2 = C.parse_pair(F.col("u"))
    got = [(r[0], r[1]) for r in df.select(c1, c2).collect()]
    want = []
    for u in units:
        m = PAIR.search(u)
        want.append((m.group(1), m.group(2)) if m else (None, None))
    assert got == want


def test_non_usd_rule_on_random_filings(spark):
    """Random filings with USD and non-USD rows, NULL and repeated dates."""
    import random
    from conftest import RawFixture, num_row, sub_row
    from test_invariants import expected_non_usd
    from ledgerlake.functions.tags import METRICS
    from ledgerlake.plans.models import FilingModels
    for seed in range(3):
        rnd = random.Random(seed)
        subs = [sub_row(f"S{i}", cik=str(i % 4)) for i in range(12)]
        nums = [num_row(f"S{rnd.randrange(12)}", rnd.choice(["Assets", "Cash", "Revenues"]),
                        rnd.choice(["20201231", "20191231", "", "20200630"]), str(rnd.randint(-5, 50)),
                        uom=rnd.choice(["USD", "EURUSD", "EUR", "USD/JPY"]), qtrs=rnd.choice(["0", "4"]))
                for _ in range(150)]
        m = FilingModels(spark, RawFixture(spark, subs, nums))
        filings = [r.asDict() for r in m.stg_sub.collect()]
        facts = [r.asDict() for r in m.stg_num.collect()]
        for name in ("assets", "revenue"):
            ours = sorted((tuple(r) for r in m.metric_view(name, "xyz").collect()), key=repr)
            assert ours == expected_non_usd(filings, facts, METRICS[name]), (seed, name)
