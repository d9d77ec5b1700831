import pytest
from conftest import num_row, sub_row

from ledgerlake.plans.models import FilingModels
from ledgerlake.plans.view_catalog import ViewCatalog
from ledgerlake.plans.views import ViewRuleError


@pytest.fixture
def small(raw_fixture):
    raw = raw_fixture([sub_row("A1"), sub_row("A2")],
                      [num_row("A1", "Assets", "20201231", "5"), num_row("A2", "Assets", "20201231", "7")])
    return FilingModels(raw.sub.sparkSession, raw)


def test_views_over_views_in_any_order(spark, small, tmp_path):
    folder = str(tmp_path / "views")
    assert ViewCatalog(spark, folder).definitions == {}
    catalog = ViewCatalog(spark, folder)
    catalog.define({"vc_top": "select t.total + d.doubled as both from vc_total t cross join vc_double d"})
    catalog.define({"vc_double": "with w as (select * from VC_TOTAL) select 2 * total as doubled from w",
                    "vc_total": "select sum(assets) as total from assets_usd where adsh in (select adsh from assets_usd)"})
    again = ViewCatalog(spark, folder)
    assert again.definitions == catalog.definitions
    assert again.order() == ["vc_total", "vc_double", "vc_top"]
    assert again.query(small, "select both from vc_top").first().both == 36
    # a changed view reaches those above it; the last definition counts after a reread, too
    again.define({"vc_total": "select max(assets) as total from assets_usd"})
    assert again.query(small, "select both from vc_top").first().both == 21
    assert ViewCatalog(spark, folder).query(small, "select both from vc_top").first().both == 21


def test_only_what_a_query_reads_is_registered(spark, small):
    catalog = ViewCatalog(spark)
    catalog.define({"vc_one": "select 1 as x", "vc_two": "select x from vc_one", "vc_broken": "select y from vc_missing"})
    assert catalog.order(["vc_two"]) == ["vc_one", "vc_two"]
    assert catalog.query(small, "select x from vc_two").first().x == 1


@pytest.mark.parametrize("definitions", [
    {"vc_a": "select * from vc_b", "vc_b": "select * from vc_c", "vc_c": "select * from vc_a"},
    {"vc_a": "select * from vc_a"},
    {"vc_a": "select x from (select 1 as x) where x in (select x from vc_b)", "vc_b": "select * from vc_a"},
    {"assets_usd": "select 1 as x"},
    {"vc_a": "with assets_usd as (select 1 as x) select * from assets_usd"},
    {"vc_a": "with vc_b as (select 1 as x) select * from vc_b", "vc_b": "select 1 as x"},
    {"vc_a": "select 1 as x", "vc_b": "drop table vc_a"},
])
def test_refused_definitions_store_nothing(spark, tmp_path, definitions):
    folder = str(tmp_path / "views")
    catalog = ViewCatalog(spark, folder)
    with pytest.raises(ViewRuleError):
        catalog.define(definitions)
    assert catalog.definitions == {} and ViewCatalog(spark, folder).definitions == {}


def test_drop(spark, tmp_path):
    folder = str(tmp_path / "views")
    catalog = ViewCatalog(spark, folder)
    catalog.define({"vc_low": "select 1 as x", "vc_high": "select * from vc_low"})
    with pytest.raises(ViewRuleError, match="vc_high"):
        catalog.drop("vc_low")
    catalog.drop("vc_high")
    catalog.drop("vc_low")
    with pytest.raises(ViewRuleError):
        catalog.drop("vc_low")
    assert ViewCatalog(spark, folder).definitions == {}
    catalog.define({"vc_low": "select 2 as x"})
    assert ViewCatalog(spark, folder).definitions == {"vc_low": "select 2 as x"}


def test_a_view_read_twice_is_written_once(spark, small):
    catalog = ViewCatalog(spark)
    catalog.define({"vc_base": "select adsh, assets from assets_usd",
                    "vc_most": "select max(assets) as most from vc_base", "vc_sum": "select sum(assets) as total from vc_base",
                    "vc_odd": "select null as nothing, assets from assets_usd"})
    out = catalog.query(small, "select most, total from vc_most cross join vc_sum")
    assert [tuple(r) for r in out.collect()] == [(7, 12)]
    written = list(small._written)
    assert len(written) == 1 and all(written[0] in f for f in out.inputFiles())
    # read by one view only, and rows that Parquet cannot hold: nothing is written
    assert catalog.query(small, "select total from vc_sum").first().total == 12
    assert catalog.query(small, "select a.assets from vc_odd a join vc_odd b on a.assets = b.assets").count() == 2
    assert small._written == written
    small.release()
    assert not small._written
