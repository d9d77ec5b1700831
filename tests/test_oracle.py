"""Every registered query against its independent DuckDB SQL on the smallest driver scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    import duckdb
    from ledgerlake.sources.adapter import DRIVER_TABLES
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _ids():
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


def test_every_inventory_query_has_an_oracle():
    """Queries of the optional subpackage that SQL cannot express have brute-force tests of their own."""
    import __spark_entry__ as E
    from ledgerlake.plans import catalog
    assert set(catalog.queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("qid", _ids())
def test_query_matches_oracle(spark, con, qid):
    import __spark_entry__ as E
    from compare_oracle import digest
    df = E.queries()[qid](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[qid])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, df.columns)[0] == digest(orows, ocols)[0]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "revenue_usd" in df.columns
