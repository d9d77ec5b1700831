import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import build_session  # noqa: E402

SUB_COLS = ["adsh", "cik", "name", "sic", "countryba", "ein", "form", "period", "fy", "fp", "filed",
            "accepted", "wksi", "prevrpt", "detail", "srcdir"]
NUM_COLS = ["adsh", "tag", "version", "coreg", "ddate", "qtrs", "uom", "segments", "value", "footnote",
            "srcdir"]


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="ledgerlake-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ll-test-wh-")})
    yield s


def sub_row(adsh, cik="0000000001", name="ACME", sic="1000", form="10-K", period="20201231",
            fy="2020", fp="FY", **kw):
    d = dict(adsh=adsh, cik=cik, name=name, sic=sic, countryba="US", ein="", form=form, period=period,
             fy=fy, fp=fp, filed="20210201", accepted="", wksi="true", prevrpt="false", detail="true",
             srcdir="2021q1")
    d.update(kw)
    return d


def num_row(adsh, tag, ddate, value, uom="USD", qtrs="0", coreg="", **kw):
    d = dict(adsh=adsh, tag=tag, version="us-gaap/2020", coreg=coreg, ddate=ddate, qtrs=qtrs, uom=uom,
             segments="", value=value, footnote="", srcdir="2021q1")
    d.update(kw)
    return d


def frame(spark, rows, cols):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


class RawFixture:
    """Hand-written raw relations with the same interface as the driver adapter."""

    def __init__(self, spark, subs, nums, esg=None, isin=None):
        from ledgerlake.sources.adapter import ESG_SIGNALS
        self.sub = frame(spark, subs, SUB_COLS)
        self.num = frame(spark, nums, NUM_COLS)
        self.tag = frame(spark, [], ["tag", "version", "custom", "abstract", "crdr", "tlabel", "doc", "srcdir"])
        from pyspark.sql import types as T
        esg_schema = T.StructType(
            [T.StructField(c, T.StringType()) for c in ("isin", "gvkey", "cusip", "hqcountrycode")]
            + [T.StructField("year", T.IntegerType())]
            + [T.StructField(c, T.DoubleType()) for c in ESG_SIGNALS])
        rows = []
        for e in esg or []:
            rows.append(tuple([e.get("isin"), e.get("gvkey"), "", "US", e.get("year")]
                              + [e.get(c) for c in ESG_SIGNALS]))
        self.esg_risk_factors = spark.createDataFrame(rows, esg_schema)
        self.isin_cik = frame(spark, isin or [], ["isin", "cik"])


@pytest.fixture
def raw_fixture(spark):
    def make(subs, nums, esg=None, isin=None):
        return RawFixture(spark, subs, nums, esg, isin)
    return make
