"""Rules of the plans: who owns persisted data, what a broadcast may weigh, how often rows move."""

import os
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import NUM_COLS, SUB_COLS, frame, num_row, sub_row
from ledgerlake.plans import sizing
from ledgerlake.plans.models import FilingModels
from ledgerlake.sources import landing
from ledgerlake.sources.archive_writer import member_lines, write_archives


def _final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[:text.index("== Initial Plan")] if "== Initial Plan" in text else text


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    side = spark.range(4).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    facts = spark.range(100)
    keep = []

    def hinted(**kw):
        df = facts.join(sizing.broadcast_if_small(side, keep=keep, **kw), "id")
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(max_rows=4) and not hinted(max_rows=3) and not hinted(max_rows=0)
    assert not hinted(max_rows=4, max_bytes=3999) and hinted(max_rows=4, max_bytes=5000)
    assert len(keep) == 4  # what is not measured is not persisted
    for df in keep:
        df.unpersist()


def test_row_bytes_of_nested_and_null_values(spark):
    df = spark.createDataFrame([(1, "ab", ["cd"]), (2, None, None)], "a int, b string, c array<string>")
    assert [r[0] for r in df.orderBy("a").select(sizing.row_bytes(df)).collect()] == [48 + 2 + 6, 48]


def test_release_frees_only_its_own_graph(spark, raw_fixture):
    subs = [sub_row("A1", cik="1"), sub_row("A2", cik="2")]
    nums = [num_row(a, t, "20201231", "5", qtrs=q) for a in ("A1", "A2") for t, q in (("Assets", "0"), ("Revenues", "4"))]
    one, two = (FilingModels(spark, raw_fixture(subs, nums)) for _ in range(2))
    first, second = one.financials(), two.financials()
    assert first.count() == second.count() == 2
    kept = list(two._persisted)
    files = one._written[0]
    one.release()
    assert not one._persisted and not one._written and not os.path.exists(files.removeprefix("file:"))
    assert kept and all(df.storageLevel.useMemory for df in two._persisted)
    assert second.count() == 2
    assert one.financials().count() == 2  # a released graph writes its tables anew
    one.release()
    two.release()


def test_financials_move_revenue_rows_twice(spark, raw_fixture):
    """Without broadcasts: one exchange by (cik, fy), one by (cik, ddate), and each side reads its
    metric's files and columns only."""
    subs = [sub_row("A1", cik="1"), sub_row("A1", cik="1", srcdir="again")]
    nums = [num_row("A1", t, "20201231", "5", qtrs=q) for t, q in (
        ("Assets", "0"), ("Cash", "0"), ("LongTermDebt", "0"), ("EntityPublicFloat", "0"), ("Revenues", "4"),
        ("NetIncomeLoss", "4"))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = FilingModels(spark, raw_fixture(subs, nums), max_broadcast_rows=0)
        df = m.financials()
        plan = _final_plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert df.count() == 2  # one row per annual filing
    lines = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln]
    keys = [ln[ln.index("[") + 1:].split("#")[0] + ln[ln.index("[") + 1:].split(", ")[1].split("#")[0] for ln in lines]
    assert keys == ["cikddate"] * 4 + ["cikfy"] * 2
    # an exchange of the left side stands below the joins that it feeds: six sides, two moves of the left
    assert plan.count("Exchange hashpartitioning(cik") == 6 + 2
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "metric" in ln]
    assert len(scans) == 6 and all("PartitionFilters: [isnotnull(metric" in ln for ln in scans)
    m.release()


def test_written_archives_read_back(spark, tmp_path):
    """Archives hold a header and all rows; names, empty members and NULL fields survive."""
    rows = spark.createDataFrame([("2020q1", "A", None), ("2020q1", "B", "tür"), ("2020q2", "C", "z")],
                                 "srcdir string, adsh string, value string")
    name = F.concat("srcdir", F.lit(".zip"))
    empty = spark.createDataFrame([("2020q3.zip", "num.txt", 0, None)],
                                  "archive string, member string, position int, line string")
    write_archives(member_lines(rows, name, "num.txt", ["adsh", "value"])
                   .unionByName(member_lines(rows, name, "sub.txt", ["adsh"], with_rows=False)).unionByName(empty),
                   str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == ["2020q1.zip", "2020q2.zip", "2020q3.zip"]
    with zipfile.ZipFile(tmp_path / "2020q1.zip") as z:
        head, *body = z.read("num.txt").decode().splitlines()
        assert head == "adsh\tvalue" and sorted(body) == ["A\t", "B\ttür"]
        assert z.read("sub.txt") == b"adsh\n"
    out = str(tmp_path / "raw")
    landing.land_archives(spark, str(tmp_path), out)
    got = sorted((r.srcdir, r.adsh, r.value) for r in landing.read_landed(spark, out, "num").collect())
    assert got == [("2020q1", "A", ""), ("2020q1", "B", "tür"), ("2020q2", "C", "z")]


@pytest.mark.parametrize("rows", [[], [("2020q1", "A")]])
def test_archives_of_few_rows(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "srcdir string, adsh string")
    write_archives(member_lines(df, F.concat("srcdir", F.lit(".zip")), "sub.txt", ["adsh"]), str(tmp_path / "z"))
    assert len(list((tmp_path / "z").glob("*.zip"))) == len(rows)


def test_facts_of_a_large_source_are_written_as_their_join_leaves_them(spark, tmp_path, monkeypatch):
    """One shuffle per join side; only a small source is spread by a second one."""
    from ledgerlake.sources import adapter, tables
    d = str(tmp_path)
    spark.range(40).selectExpr("id as o_orderkey", "timestamp '1995-02-03' as o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.range(160).selectExpr(
        "id % 40 as l_orderkey", "id as l_partkey", "id as l_suppkey", "cast(id % 4 as int) as l_linenumber",
        "cast(id as double) as l_quantity", "cast(id as double) as l_extendedprice", "0.1d as l_discount",
        "timestamp '1995-03-04' as l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    seen = []
    land = tables.land_table
    monkeypatch.setattr(tables, "land_table", lambda *a, **kw: seen.append(kw["files"]) or land(*a, **kw))
    monkeypatch.setattr(adapter.DriverRaw, "_landed", {})
    small = adapter.DriverRaw(spark, d).num
    assert seen == [spark.sparkContext.defaultParallelism]
    rows = sorted(map(tuple, small.collect()), key=str)
    monkeypatch.setattr(adapter.DriverRaw, "_source_bytes", lambda self: 1 << 30)
    monkeypatch.setattr(adapter.DriverRaw, "_landed", {})
    large = adapter.DriverRaw(spark, d).num
    assert seen[1:] == [None] and sorted(map(tuple, large.collect()), key=str) == rows and len(rows) == 160


def test_models_shuffle_in_small_partitions(spark):
    from ledgerlake.session import apply_conf
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64MB")
        apply_conf(spark, models=False)
        assert spark.conf.get(key) == "64MB"
        apply_conf(spark)
        assert int(spark.conf.get(key)) == 16 << 20
    finally:
        spark.conf.set(key, before)


def test_rows_of_an_archive_are_not_sorted_before_they_are_written(spark, tmp_path):
    rows = spark.range(1000).selectExpr("concat('2020q', id % 4 + 1) as srcdir", "cast(id as string) as adsh")
    write_archives(member_lines(rows, F.concat("srcdir", F.lit(".zip")), "num.txt", ["adsh"]), str(tmp_path / "z"))
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    out = str(tmp_path / "raw")
    landing.land_archives(spark, str(tmp_path / "z"), out)
    landed = landing.read_landed(spark, out, "num")
    got = sorted((r.srcdir, r.adsh) for r in landed.collect())
    assert got == sorted((r.srcdir, r.adsh) for r in rows.collect())


def test_lines_travel_to_their_archive_packed(monkeypatch):
    """Runs of one (archive, member, position), not lines, go through the shuffle; none is lost when runs are cut."""
    import zlib

    import pyarrow as pa

    from ledgerlake.sources import archive_writer
    rows = [(f"q{i % 3}.zip", "num.txt", 1, f"line {i} é") for i in range(3000)] + [("q9.zip", "num.txt", 0, None)]
    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("position", pa.int32()), ("line", pa.string())])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i:i + 500]], schema)
               for i in range(0, len(rows), 500)]

    def packed():
        return [tuple(b.to_pylist()[0].values()) for b in archive_writer._pack(iter(batches))]
    assert len(packed()) == 4
    monkeypatch.setattr(archive_writer, "RUN_BYTES", 2000)
    monkeypatch.setattr(archive_writer, "OPEN_RUNS", 2)
    runs = packed()
    assert len(runs) > 4
    lines = sorted((a, line) for a, _, _, run in runs for line in zlib.decompress(run).decode().splitlines())
    assert lines == sorted((a, line) for a, _, _, line in rows if line is not None)
    assert zlib.decompress([run for a, _, _, run in runs if a == "q9.zip"][0]) == b""


def test_lines_cut_from_blocks_are_those_of_a_text_reader(monkeypatch):
    """Ends, byte order marks and bytes that are no UTF-8, wherever a block ends."""
    import io
    import random

    from ledgerlake.sources import archive_source
    rng = random.Random(7)
    pieces = [b"a", b"bc", b"\n", b"\r", b"\r\n", b"\xef\xbb\xbf", b"\xff", b"\xc3", b"\xc3\xbc", b"\xe2\x82", b"\t"]
    monkeypatch.setattr(archive_source, "BLOCK_BYTES", 7)
    for _ in range(300):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("num.txt", b"".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))))
        with zipfile.ZipFile(buffer) as z:
            want = [(f + i, t) for f, run in archive_source.member_lines(z, "num.txt", 3) for i, t in enumerate(run)]
            got = [(f + i, t) for f, run in archive_source.member_line_arrays(z, "num.txt", 3)
                   for i, t in enumerate(run.to_pylist())]
        assert got == want


def _two_archives(at, second):
    at.mkdir()
    for name, header in (("2021q1", "adsh\ttag\tvalue"), ("2021q2", second)):
        with zipfile.ZipFile(at / f"{name}.zip", "w") as z:
            z.writestr("sub.txt", "adsh\tcik\nA1\t1\n")
            z.writestr("num.txt", f"{header}\nA1\tCash\t5\nA2\tDebt\n")
            z.writestr("tag.txt", "tag\tversion\nCash\tx\n")
    return str(at)


def test_tables_are_landed_at_once(spark, tmp_path, monkeypatch):
    """No table waits for the last archive of the one before it."""
    meet, write = threading.Barrier(3, timeout=60), landing._write_aside

    def together(*a):
        meet.wait()
        return write(*a)
    monkeypatch.setattr(landing, "_write_aside", together)
    out = str(tmp_path / "out")
    written = landing.land_archives(spark, _two_archives(tmp_path / "zips", "adsh\ttag\tvalue"), out)
    assert written == {t: ["2021q1", "2021q2"] for t in ("sub", "num", "tag")}
    assert [landing.read_landed(spark, out, t).count() for t in ("sub", "num", "tag")] == [2, 4, 2]

    def die(spark, lines, load, table, root):
        raise RuntimeError(table)
    monkeypatch.setattr(landing, "_write_aside", die)
    with pytest.raises(RuntimeError):
        landing.land_archives(spark, str(tmp_path / "zips"), out)
    assert landing.read_landed(spark, out, "num").count() == 4


@pytest.mark.parametrize("second, looked_up", [("adsh\ttag\tvalue", False), ("tag\tadsh\tvalue", True)])
def test_columns_with_one_place_are_not_looked_up_per_line(spark, tmp_path, second, looked_up):
    archives = landing.list_archives(spark, _two_archives(tmp_path / "zips", second))
    headers = landing.archive_headers(archives)
    known = [r["header"] for r in headers.filter("table = 'num'").collect()]
    lines, columns = landing.archive_lines(archives, members=("num.txt",)), landing._columns("num", headers.collect())
    fast = landing.rows_for_table(lines, headers, "num", columns, known=known)
    assert ("element_at" in fast._jdf.queryExecution().optimizedPlan().toString()) == looked_up
    assert sorted(map(str, fast.collect())) == sorted(map(str, landing.rows_for_table(lines, headers, "num", columns).collect()))
    assert {r["value"] for r in fast.collect()} == {"5", ""} and {r["coreg"] for r in fast.collect()} == {None}


def test_a_persisted_part_of_the_faulty_rows_is_known_in_a_larger_plan(spark):
    from ledgerlake.sources.adapter import dirty_sql
    subs = frame(spark, [sub_row("A000000000011"), sub_row("A000000000012")], SUB_COLS)
    nums = frame(spark, [num_row("A000000000011", "Assets", "20201231", "5.17")], NUM_COLS)
    sub, num = spark.sql(dirty_sql()["raw_sub"], raw_sub=subs), spark.sql(dirty_sql()["raw_num"], raw_num=nums)
    keys = sub.select("adsh", "srcdir").distinct().persist()
    try:
        assert keys.count() == 3  # one is filed in two quarters
        joined = num.drop("srcdir").join(keys, "adsh")
        assert "InMemoryTableScan" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 4  # the fact is there twice
    finally:
        keys.unpersist()


def test_persisted_sides_have_partitions_by_their_size(spark):
    from ledgerlake.session import apply_conf
    apply_conf(spark)
    small = spark.range(50).withColumn("k", F.col("id") % 7).groupBy("k").count().persist()
    try:
        assert small.count() == 7 and small.rdd.getNumPartitions() < int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        small.unpersist()


def test_shuffles_begin_in_partitions_by_the_source(spark, tmp_path):
    """A fixed number of partitions would grow with the input, and the memory of a task with them."""
    import __spark_entry__ as entry
    from ledgerlake import session
    from ledgerlake.plans import catalog
    key, d, seen = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(tmp_path), []
    spark.range(40).selectExpr("id as c_custkey").write.parquet(f"{d}/customer.parquet")
    was, registry = spark.conf.get(key, None), dict(catalog.REGISTRY)
    catalog.REGISTRY["seen"] = (lambda s, d: seen.append(s.conf.get(key, None)) or s.range(1), ())
    per = session.SOURCE_BYTES_PER_PARTITION
    try:
        spark.conf.unset(key)
        entry.queries()["seen"](spark, d)
        session.SOURCE_BYTES_PER_PARTITION = 10
        entry.queries()["seen"](spark, d)
        assert seen[0] is None and int(seen[1]) > int(spark.conf.get("spark.sql.shuffle.partitions"))
        session.size_shuffles(spark, 0)
        assert spark.conf.get(key) == seen[1]
    finally:
        session.SOURCE_BYTES_PER_PARTITION = per
        catalog.REGISTRY.clear()
        catalog.REGISTRY.update(registry)
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def test_signals_of_the_panel_are_written_by_many_tasks(spark, tmp_path):
    from ledgerlake.sources.adapter import DriverRaw
    d = str(tmp_path)
    rows = [*range(400), 7, None]
    spark.createDataFrame([(k,) for k in rows], "c_custkey long").coalesce(1).write.parquet(f"{d}/customer.parquet")
    panel = DriverRaw(spark, d, land=False).esg_risk_factors
    assert panel.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(((r.gvkey, r.year) for r in panel.collect()), key=str) == sorted(
        ((None if k is None else str(k), 2019 + y) for k in rows for y in range(3)), key=str)
