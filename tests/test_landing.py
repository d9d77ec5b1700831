"""Archive landing: parsing rules, schema evolution, load modes (FIXTURES.md section 4, cases 1-5)."""

import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import landing


def make_zip(folder, name, members):
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w") as z:
        for member, text in members.items():
            z.writestr(member, text.encode("utf-8"))
    return path


def test_normalize_fields(spark):
    df = spark.createDataFrame([("a\tb",), ("a\tb\tc\td\te",), ("x\t\ty",)], "line string")
    out = [r[0] for r in df.select(landing.normalize_fields(landing.split_fields(F.col("line")), 3)).collect()]
    assert out[0] == ["a", "b", ""]
    assert out[1] == ["a", "b", "c\td\te"]
    assert out[2] == ["x", "", "y"]
    pad4 = df.limit(1).select(landing.normalize_fields(landing.split_fields(F.col("line")), 4)).first()[0]
    assert pad4 == ["a", "b", "", ""]


def test_srcdir_of(spark):
    df = spark.createDataFrame([("file:/x/y/2019q4.zip",), ("/a/2020q1.v2.zip",)], "p string")
    assert [r[0] for r in df.select(landing.srcdir_of("p")).collect()] == ["2019q4", "2020q1"]


def _root():
    return tempfile.mkdtemp(prefix="ll-land-")


def test_land_parse_rules_and_schema_evolution(spark):
    zips = _root()
    out = os.path.join(_root(), "raw")
    make_zip(zips, "2020q1.zip", {
        "sub.txt": "﻿adsh\tcik\tname\r\nA1\t1\tSay \"hi\"\r\n\r\nA2\t2\r\n",
        "num.txt": "adsh\ttag\tvalue\nA1\tAssets\t5\textra\tmore\n",
        "tag.txt": "",
        "readme.txt": "ignored",
    })
    make_zip(zips, "2020q2.zip", {"sub.txt": "adsh\tcik\tname\tx\nB1\t3\tB\tnew\n"})
    with open(os.path.join(zips, "notes.txt"), "w") as fh:
        fh.write("not an archive")
    landing.land_archives(spark, zips, out, mode="append")
    sub = landing.read_landed(spark, out, "sub")
    got = {r.adsh: r for r in sub.collect()}
    assert set(got) == {"A1", "A2", "B1"}
    assert got["A1"].name == 'Say "hi"'          # BOM stripped from header, quotes kept
    assert got["A2"].name == ""                  # short row padded
    assert got["A1"].x is None and got["B1"].x == "new"   # column added by a later archive
    assert got["A1"].srcdir == "2020q1" and got["B1"].srcdir == "2020q2"
    num = landing.read_landed(spark, out, "num").first()
    assert num.value == "5\textra\tmore"         # extra fields folded into the last column
    assert not os.path.exists(os.path.join(out, "tag")) or landing.read_landed(spark, out, "tag").count() == 0


@pytest.mark.parametrize("mode,expect", [("append", 4), ("skip", 2), ("replace", 2)])
@pytest.mark.parametrize("read_content", [False, True])
def test_reload_modes(spark, mode, expect, read_content):
    zips = _root()
    out = os.path.join(_root(), "raw")
    make_zip(zips, "2021q1.zip", {"sub.txt": "adsh\tcik\nA1\t1\nA2\t2\n"})
    landing.land_archives(spark, zips, out, mode="append", read_content=read_content)
    landing.land_archives(spark, zips, out, mode=mode, read_content=read_content)
    assert landing.read_landed(spark, out, "sub").count() == expect


def test_missing_dir_and_empty_dir(spark):
    with pytest.raises(FileNotFoundError):
        landing.land_archives(spark, "/nonexistent/dir/xyz", _root())
    with pytest.raises(FileNotFoundError):
        landing.land_archives(spark, _root(), _root())


def test_incremental_landing_only_new_archives(spark):
    from ledgerlake.streaming import start_incremental_landing
    zips = _root()
    out = os.path.join(_root(), "raw")
    ckpt = os.path.join(_root(), "stream")
    make_zip(zips, "2022q1.zip", {"sub.txt": "adsh\tcik\nA1\t1\nA2\t2\n"})
    start_incremental_landing(spark, zips, out, ckpt).awaitTermination()
    assert landing.read_landed(spark, out, "sub").count() == 2
    make_zip(zips, "2022q2.zip", {"sub.txt": "adsh\tcik\nB1\t3\n", "num.txt": "adsh\ttag\nB1\tAssets\n"})
    start_incremental_landing(spark, zips, out, ckpt).awaitTermination()
    sub = landing.read_landed(spark, out, "sub")
    assert sub.count() == 3 and sorted(r.srcdir for r in sub.select("srcdir").distinct().collect()) == ["2022q1", "2022q2"]
    assert landing.read_landed(spark, out, "num").count() == 1


def test_register_view_rules(spark):
    from ledgerlake.plans import views
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("base_kpi_src")
    df = views.register_view(spark, "my_kpi_view", "select x * 2 as y from base_kpi_src")
    assert spark.table("my_kpi_view").first().y == 2 and df.count() == 1
    for name, sql in [("BadName", "select 1"), ("a" * 50, "select 1"), ("ok_name", "select 1;"),
                      ("ok_name", "delete from t"), ("ok_name", "select * from db.t"),
                      ("ok_name", "select 1; select 2")]:
        with pytest.raises(views.ViewRuleError):
            views.register_view(spark, name, sql)


def test_line_endings_and_bad_bytes(spark):
    zips = _root()
    out = os.path.join(_root(), "raw")
    path = os.path.join(zips, "2023q4.zip")
    with zipfile.ZipFile(path, "w") as z:
        # CR-only and CRLF line ends, a blank CRLF line, an invalid UTF-8 byte
        z.writestr("sub.txt", b"adsh\tname\r\nA1\tfoo\rA2\tb\xffr\r\n\r\nA3\tbaz")
    landing.land_archives(spark, zips, out)
    got = {r.adsh: r.name for r in landing.read_landed(spark, out, "sub").collect()}
    assert got == {"A1": "foo", "A2": "b�r", "A3": "baz"}


def test_lines_are_spread_where_archives_are_few_or_uneven():
    mb = 1 << 20
    assert landing.line_partitions([], 8) == 0
    assert landing.line_partitions([mb] * 8, 8) == 0
    assert landing.line_partitions([mb] * 7, 8) == 8            # fewer archives than cores
    assert landing.line_partitions([mb] * 8 + [4 * mb], 8) == 8  # one far larger than the rest
    assert landing.line_partitions([1 << 30], 8) == 64


def test_rebalance_gives_same_rows(spark, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_RUN", 50)
    zips = _root()
    body = "".join(f"A{i}\t{i}\n" for i in range(500))
    make_zip(zips, "2024q1.zip", {"sub.txt": "adsh\tcik\n" + body})
    a, b = os.path.join(_root(), "raw"), os.path.join(_root(), "raw")
    landing.land_archives(spark, zips, a)
    landing.land_archives(spark, zips, b, rebalance=4)
    ra, rb = landing.read_landed(spark, a, "sub"), landing.read_landed(spark, b, "sub")
    assert ra.count() == rb.count() == 500 and ra.exceptAll(rb).count() == 0


def test_two_archives_of_one_srcdir(spark):
    """Lines go with the header of their own archive; append keeps both, replace the last, skip the first."""
    zips = _root()
    make_zip(zips, "2019q4.zip", {"sub.txt": "adsh\tcik\nA1\t1\n"})
    make_zip(zips, "2019q4.v2.zip", {"sub.txt": "cik\tadsh\textra\n2\tB1\tz\n"})
    order = sorted(["2019q4.zip", "2019q4.v2.zip"])
    one = {"2019q4.zip": ("A1", "1", None), "2019q4.v2.zip": ("B1", "2", "z")}
    for mode, want in (("append", list(one.values())), ("replace", [one[order[-1]]]), ("skip", [one[order[0]]])):
        out = os.path.join(_root(), "raw")
        landing.land_archives(spark, zips, out, mode=mode)
        rows = landing.read_landed(spark, out, "sub")
        extra = F.col("extra") if "extra" in rows.columns else F.lit(None).cast("string")
        assert sorted(map(tuple, rows.select("adsh", "cik", extra).collect())) == sorted(want), mode


@pytest.mark.parametrize("text", ["", "adsh\tcik\n", "adsh\tcik\r\n\r\n"])
def test_replace_by_a_member_without_rows(spark, text):
    out = os.path.join(_root(), "raw")
    first, second = _root(), _root()
    make_zip(first, "2021q1.zip", {"sub.txt": "adsh\tcik\nA1\t1\n"})
    make_zip(first, "2021q2.zip", {"sub.txt": "adsh\tcik\nB1\t2\n"})
    make_zip(second, "2021q1.zip", {"sub.txt": text})
    landing.land_archives(spark, first, out, mode="replace")
    assert landing.land_archives(spark, second, out, mode="replace")["sub"] == []
    assert [r.adsh for r in landing.read_landed(spark, out, "sub").collect()] == ["B1"]


def test_stream_takes_empty_members_and_reads_no_archive_whole(spark):
    from ledgerlake.streaming import start_incremental_landing
    zips, out, ckpt = _root(), os.path.join(_root(), "raw"), os.path.join(_root(), "stream")
    make_zip(zips, "2021q1.zip", {"sub.txt": "adsh\tcik\nA1\t1\n", "num.txt": "", "tag.txt": "tag\n"})
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10")
    try:
        start_incremental_landing(spark, zips, out, stream_checkpoint=ckpt).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert [r.adsh for r in landing.read_landed(spark, out, "sub").collect()] == ["A1"]


@pytest.mark.parametrize("sql,good", [
    ("select extract(year from f.x) as y from base_kpi_dates f", True),
    ("select ';' as mark, x from base_kpi_dates", True),
    ("with a as (select * from base_kpi_dates) select * from a where x in (select x from base_kpi_dates)", True),
    ("with a as (select 1 as x) insert into t select * from a", False),
    ("select * from base_kpi_dates, otherdb.t", False),
    ("select 1; select 2", False),
    ("drop table base_kpi_dates", False),
])
def test_view_rules_by_the_parser(spark, sql, good):
    from ledgerlake.plans import views
    spark.sql("select date '2020-01-01' as x").createOrReplaceTempView("base_kpi_dates")
    if good:
        views.register_view(spark, "parsed_kpi_view", sql)
        assert spark.table("parsed_kpi_view").count() == 1
    else:
        with pytest.raises(views.ViewRuleError):
            views.register_view(spark, "parsed_kpi_view", sql)


def test_a_filing_in_two_srcdirs_keeps_both_reported_floats(raw_fixture):
    """Reported floats keep the source's join multiplicity; metrics stay one row."""
    from conftest import num_row, sub_row
    from ledgerlake.plans.models import FilingModels
    raw = raw_fixture([sub_row("S1"), sub_row("S1", srcdir="2021q2")],
                      [num_row("S1", "EntityPublicFloat", "20201231", "5"), num_row("S1", "Assets", "20201231", "7")])
    m = FilingModels(raw.sub.sparkSession, raw)
    assert m.float_inferred.count() == 2 and m.metric_view("assets", "usd").count() == 1


def test_strict_mode_fails_in_every_reader_of_facts(raw_fixture):
    from conftest import num_row, sub_row
    from ledgerlake.plans.models import FilingModels
    raw = raw_fixture([sub_row("S1")], [num_row("S1", "Assets", "20201231", "12,5")])
    for read in (lambda m: m.stg_num, lambda m: m.metric_view("assets", "usd"), lambda m: m.facts):
        with pytest.raises(ValueError):
            read(FilingModels(raw.sub.sparkSession, raw, strict=True))
