"""The landing log, the archive source and the keyed state of the stream."""

import os
import tempfile
import zipfile

import pytest

from ledgerlake.sources import landing, landing_log
from ledgerlake.sources.archive_source import ArchiveReader, archive_reader, srcdir_name
from ledgerlake.streaming import start_incremental_landing


def folder():
    return tempfile.mkdtemp(prefix="ll-log-")


def make_zip(at, name, **members):
    with zipfile.ZipFile(os.path.join(at, name), "w") as z:
        for member, text in members.items():
            z.writestr(f"{member}.txt", text)


def rows(spark, root, table, *cols, **kw):
    return sorted(tuple(r) for r in landing.read_landed(spark, root, table, **kw).select(*cols).collect())


def jobs_of(spark, run):
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reading_opens_no_footer(spark):
    zips, root = folder(), folder() + "/raw"
    for q in range(1, 5):
        make_zip(zips, f"2020q{q}.zip", sub=f"adsh\tcik\tnew{q}\nA{q}\t1\tx\n", num="adsh\ttag\nA\tAssets\n")
    landing.land_archives(spark, zips, root)
    df, jobs = jobs_of(spark, lambda: landing.read_landed(spark, root, "sub"))
    assert jobs == 0  # columns and folders are the log's
    assert [c for c in df.columns if c.startswith("new")] == ["new1", "new2", "new3", "new4"]
    assert sorted((r.adsh, r.new1, r.new3) for r in df.collect()) == [
        ("A1", "x", None), ("A2", None, None), ("A3", None, "x"), ("A4", None, None)]
    plan = df.filter("srcdir = '2020q2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2020q2" in plan


def test_a_landing_killed_between_tables_changes_nothing(spark, monkeypatch):
    first, second, root = folder(), folder(), folder() + "/raw"
    make_zip(first, "2020q1.zip", sub="adsh\tcik\nOLD\t1\n", num="adsh\ttag\nOLD\tAssets\n", tag="tag\nold\n")
    make_zip(second, "2020q1.zip", sub="adsh\tcik\textra\nNEW\t1\te\n", num="adsh\ttag\nNEW\tAssets\n", tag="tag\nnew\n")
    landing.land_archives(spark, first, root, mode="replace")
    whole = landing._write_aside

    def write(sp, lines, load, table, out):
        if table == "num":
            raise RuntimeError("killed")  # sub is written by now
        return whole(sp, lines, load, table, out)
    monkeypatch.setattr(landing, "_write_aside", write)
    with pytest.raises(RuntimeError):
        landing.land_archives(spark, second, root, mode="replace")
    monkeypatch.undo()
    for table, col in (("sub", "adsh"), ("num", "adsh"), ("tag", "tag")):
        assert rows(spark, root, table, col) == [("OLD" if col == "adsh" else "old",)]
    assert "extra" not in landing.read_landed(spark, root, "sub").columns
    landing.land_archives(spark, second, root, mode="replace")
    assert rows(spark, root, "sub", "adsh", "extra") == [("NEW", "e")] and rows(spark, root, "tag", "tag") == [("new",)]


def test_versions_and_vacuum(spark):
    root = folder() + "/raw"
    for k in range(4):
        zips = folder()
        make_zip(zips, "2020q1.zip", sub=f"adsh\tcik\nV{k}\t1\n")
        landing.land_archives(spark, zips, root, mode="replace")
    assert landing_log.versions(spark, root) == [1, 2, 3, 4]
    assert rows(spark, root, "sub", "adsh", version=2) == [("V1",)]
    aside = f"{root}/sub/{landing_log.LOAD}=running"
    os.makedirs(aside)
    assert landing_log.vacuum(spark, root, keep_versions=2) == []  # nothing is old enough
    gone = landing_log.vacuum(spark, root, keep_versions=2, min_age_s=-1)
    assert len(gone) == 3 and not os.path.exists(aside)
    assert landing_log.versions(spark, root) == [3, 4]
    assert rows(spark, root, "sub", "adsh") == [("V3",)] and rows(spark, root, "sub", "adsh", version=3) == [("V2",)]


def test_a_commit_that_comes_second_is_applied_to_the_first(spark):
    """Two landings of one root at once: both stay, and 'skip' sees what came first."""
    a, b, c, root = folder(), folder(), folder(), folder() + "/raw"
    make_zip(a, "2020q1.zip", sub="adsh\tcik\nA\t1\n")
    make_zip(b, "2020q2.zip", sub="adsh\tcik\nB\t1\n")
    make_zip(c, "2020q1.zip", sub="adsh\tcik\nC\t1\n")
    landing.land_archives(spark, a, root, mode="skip",
                          before_commit=lambda: (landing.land_archives(spark, b, root),
                                                 landing.land_archives(spark, c, root, mode="skip")))
    assert rows(spark, root, "sub", "adsh", "srcdir") == [("B", "2020q2"), ("C", "2020q1")]


def test_skip_loads_where_only_an_empty_member_was_landed(spark):
    empty, full, root = folder(), folder(), folder() + "/raw"
    make_zip(empty, "2020q1.zip", sub="adsh\tcik\n")
    make_zip(full, "2020q1.zip", sub="adsh\tcik\nA\t1\n")
    landing.land_archives(spark, empty, root, mode="replace")
    landing.land_archives(spark, full, root, mode="skip")
    assert rows(spark, root, "sub", "adsh") == [("A",)]


@pytest.mark.parametrize("name", ["2019q4#x.zip", "2019q4%41.zip", "a=b.zip", "a b.zip", "q[1]{2}?.zip", "é'\".zip"])
def test_odd_names(spark, name):
    zips, root = folder(), folder() + "/raw"
    make_zip(zips, name, sub="adsh\tcik\nA\t1\n")
    for mode in ("append", "skip", "replace"):
        landing.land_archives(spark, zips, root, mode=mode)
        assert rows(spark, root, "sub", "adsh", "srcdir") == [("A", srcdir_name(name))]


# ---------------------------------------------------------------- data source

def test_source_plans_only_what_the_filters_leave(spark):
    zips = folder()
    for q in range(1, 4):
        make_zip(zips, f"2020q{q}.zip", sub=f"adsh\nA{q}\n", num="﻿adsh\ttag\nN\tT\n")
    with open(os.path.join(zips, "2020q4.zip"), "w") as f:
        f.write("no archive")  # opening it would fail
    lines = archive_reader(spark).load(zips).filter("srcdir = '2020q2' and table in ('sub', 'num')")
    assert lines.rdd.getNumPartitions() == 2
    assert sorted((r.table, r.line_no, r.line) for r in lines.collect()) == [
        ("num", 0, "adsh\ttag\n"), ("num", 1, "N\tT\n"), ("sub", 0, "adsh\n"), ("sub", 1, "A2\n")]
    assert "2020q2" not in "".join(x for x in lines._jdf.queryExecution().executedPlan().toString().split("\n") if "Filter" in x
                                   and "PushedFilters" not in x)
    assert archive_reader(spark).load(zips).filter("srcdir = 'none'").count() == 0
    assert archive_reader(spark).load(zips).filter("srcdir = '2020q1' and line like 'A%'").count() == 1


def test_source_reads_long_members_in_batches(spark):
    zips = folder()
    make_zip(zips, "2020q1.zip", sub="adsh\n" + "".join(f"A{i}\n" for i in range(2500)))
    reader = ArchiveReader({"path": zips, "batchLines": "1000"})
    batches = [list(reader.read(p)) for p in reader.partitions() if p.member == "sub.txt"][0]
    assert [b.num_rows for b in batches] == [1000, 1000, 501]
    got = archive_reader(spark).option("members", "sub.txt").load(zips).selectExpr("max(line_no)", "count(*)").first()
    assert tuple(got) == (2500, 2501)


# ---------------------------------------------------------------- stream

@pytest.mark.parametrize("max_files", [1, 2, 10_000])
@pytest.mark.parametrize("order", [("2019q4.v2.zip", "2019q4.zip"), ("2019q4.zip", "2019q4.v2.zip")])
def test_rows_do_not_depend_on_batches_or_arrival(spark, max_files, order):
    zips, root, ckpt = folder(), folder() + "/raw", folder()
    members = {"2019q4.zip": dict(sub="adsh\tcik\nPLAIN\t1\n", num="adsh\ttag\nPLAIN\tT\n", tag="tag\nplain\n"),
               "2019q4.v2.zip": dict(sub="cik\tadsh\tmore\n2\tV2\tm\n", num="adsh\ttag\n"), "2020q1.zip": dict(sub="adsh\nB\n")}
    for k, name in enumerate((*order, "2020q1.zip")):
        make_zip(zips, name, **members[name])
        os.utime(os.path.join(zips, name), (1_600_000_000 + k, 1_600_000_000 + k))
    start_incremental_landing(spark, zips, root, ckpt, max_files_per_trigger=max_files).awaitTermination()
    assert rows(spark, root, "sub", "adsh", "more") == [("B", None), ("PLAIN", None)]  # '.v' comes before '.z'
    assert rows(spark, root, "num", "adsh") == [("PLAIN",)] and rows(spark, root, "tag", "tag") == [("plain",)]


def test_a_later_run_keeps_the_winner(spark):
    zips, root, ckpt = folder(), folder() + "/raw", folder()
    make_zip(zips, "2019q4.zip", sub="adsh\nLAST\n")
    start_incremental_landing(spark, zips, root, ckpt).awaitTermination()
    make_zip(zips, "2019q4.a.zip", sub="adsh\nFIRST\n", num="adsh\nN\n")
    start_incremental_landing(spark, zips, root, ckpt).awaitTermination()
    assert rows(spark, root, "sub", "adsh") == [("LAST",)] and rows(spark, root, "num", "adsh") == [("N",)]
    other = folder()  # another folder is another delivery
    make_zip(other, "2019q4.a.zip", sub="adsh\nOTHER\n")
    start_incremental_landing(spark, other, root, folder()).awaitTermination()
    assert rows(spark, root, "sub", "adsh") == [("OTHER",)]
