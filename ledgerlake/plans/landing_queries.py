"""Registered queries of landing, seeds and publication (A1-A4, A6-A13, N).

The driver tables hold no archives, so the queries write sets of them from the raw tables and land those.
``first`` holds all facts; ``second`` holds, per quarter of the year: 1 a member with a header only,
2 an empty member, 3 two archives with one srcdir (the one named ``v2`` with other columns
in another order), 4 nothing.  ``whole`` has submissions, facts and tags; in ``headers`` every
quarter of the year has its own columns of the facts.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import landing
from ..sources.adapter import DriverRaw
from ..sources.archive_source import archive_reader
from ..sources.archive_writer import member_lines, write_archives
from ..sources.seeds import read_seed
from ..streaming.incremental_landing import start_incremental_landing
from . import views
from .models import FilingModels
from .upkeep import UpkeptTables
from .view_catalog import ViewCatalog

NUM_COLUMNS = list(landing.RAW_BASE_COLUMNS["num"])
#: Columns of the facts by quarter of the year in the set ``headers``.
QUARTER_COLUMNS = {1: NUM_COLUMNS, 2: [c for c in NUM_COLUMNS if c not in ("coreg", "footnote")],
                   3: ["filer", *reversed(NUM_COLUMNS)], 4: [*NUM_COLUMNS, "note"]}
V2_COLUMNS = ["value", "note", "ddate", "adsh", "tag", "version", "coreg", "qtrs", "uom", "footnote"]
USER_VIEW = ("assets_by_industry",
             "with big as (select * from assets_usd where assets > 1000) "
             "select sic, extract(year from fy) as fiscal_year, count(*) as filings, max(assets) as most_assets, "
             "';' as mark from big group by sic, fy")
# Each reads views that are defined after it; two of them meet again in the first.
VIEW_STACK = {
    "margin_by_industry": "select y.sic, y.fiscal_year, y.filings, y.revenue, i.income from revenue_by_industry y "
                          "join income_by_industry i on y.sic = i.sic and y.fiscal_year = i.fiscal_year",
    "revenue_by_industry": "select sic, year(fy) as fiscal_year, count(*) as filings, sum(revenue) as revenue "
                           "from industry_filings group by sic, year(fy)",
    "income_by_industry": "with known as (select * from industry_filings where income is not null) "
                          "select sic, year(fy) as fiscal_year, sum(income) as income from known group by sic, year(fy)",
    "industry_filings": "select r.sic, r.fy, r.revenue, i.income from fy_revenue_usd r "
                        "left join fy_income_usd i on r.adsh = i.adsh and r.ddate = i.ddate",
}

_sets: dict = {}
_lock = threading.Lock()


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/landing/{name}-{uuid.uuid4().hex}"


def _write_set(spark: SparkSession, sf_dir: str, name: str, folder: str) -> None:
    raw = DriverRaw(spark, sf_dir)
    num, plain = raw.num, F.concat("srcdir", F.lit(".zip"))

    def quarter(n):
        return num.filter(F.col("srcdir").endswith(f"q{n}"))
    if name == "first":
        lines = member_lines(num, plain, "num.txt", NUM_COLUMNS)
    elif name == "second":
        empty = quarter(2).select(plain.alias("archive")).distinct().select(
            "archive", F.lit("num.txt").alias("member"), F.lit(0).alias("position"),
            F.lit(None).cast("string").alias("line"))
        v2 = quarter(3).filter("tag = 'Cash'").withColumn("note", F.lit("v2"))
        lines = (member_lines(quarter(1), plain, "num.txt", NUM_COLUMNS, with_rows=False)
                 .unionByName(empty)
                 .unionByName(member_lines(quarter(3).filter("tag = 'Assets'"), plain, "num.txt", NUM_COLUMNS))
                 .unionByName(member_lines(v2, F.concat("srcdir", F.lit(".v2.zip")), "num.txt", V2_COLUMNS)))
    elif name == "whole":
        lines = member_lines(raw.sub, plain, "sub.txt", [c for c in raw.sub.columns if c != "srcdir"])
        lines = lines.unionByName(member_lines(num, plain, "num.txt", NUM_COLUMNS))
        lines = lines.unionByName(member_lines(raw.tag, plain, "tag.txt", [c for c in raw.tag.columns if c != "srcdir"]))
    else:
        lines = None
        for n, columns in QUARTER_COLUMNS.items():
            rows = quarter(n).withColumn("note", F.lit("q4")).withColumn("filer", F.substring("adsh", -4, 4))
            own = member_lines(rows, plain, "num.txt", columns)
            lines = own if lines is None else lines.unionByName(own)
    write_archives(lines, folder)


def _archive_set(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a set, written once per application."""
    with _lock:
        ident = (spark.sparkContext.applicationId, sf_dir, name)
        if ident not in _sets:
            folder = _scratch(spark, name)
            _write_set(spark, sf_dir, name, folder)
            _sets[ident] = folder
        return _sets[ident]


def _archive_sets(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return _archive_set(spark, sf_dir, "first"), _archive_set(spark, sf_dir, "second")


def _whole_landed(spark: SparkSession, sf_dir: str) -> str:
    """Root with the set ``whole`` landed, once per application."""
    folder = _archive_set(spark, sf_dir, "whole")
    with _lock:
        ident = (spark.sparkContext.applicationId, sf_dir, "whole landed")
        if ident not in _sets:
            out = _scratch(spark, "whole-landed")
            landing.land_archives(spark, folder, out, mode="replace")
            _sets[ident] = out
        return _sets[ident]


def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every submissions member, by the data source."""
    lines = archive_reader(spark).load(_archive_set(spark, sf_dir, "whole"))
    return lines.filter("table = 'sub' and line_no > 0").select("srcdir", "table", landing.clean_line("line").alias("line"))


def landed_member(table: str):
    """One raw table of the archives that hold all three members."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return landing.read_landed(spark, _whole_landed(spark, sf_dir), table)
    return query


def models_from_archives(spark: SparkSession, sf_dir: str) -> FilingModels:
    """The model graph over landed archives."""
    raw = DriverRaw(spark, sf_dir)
    return FilingModels(spark, landing.LandedRaw(spark, _whole_landed(spark, sf_dir), {
        "esg_risk_factors": raw.esg_risk_factors, "isin_cik": raw.isin_cik}))


def _upkept(spark: SparkSession, sf_dir: str) -> UpkeptTables:
    """Tables kept up over two landings, the odd quarters and then the even ones, once per application."""
    archives = landing.list_archives(spark, _archive_set(spark, sf_dir, "whole"))
    with _lock:
        ident = (spark.sparkContext.applicationId, sf_dir, "upkept")
        if ident not in _sets:
            raw, kept = _scratch(spark, "upkept-landed"), _scratch(spark, "upkept")
            for quarters in ("q1|q3", "q2|q4"):
                landing.land_listed(archives.filter(F.col("srcdir").rlike(f"({quarters})$")), raw)
                UpkeptTables(spark, raw, kept).refresh()
            _sets[ident] = UpkeptTables(spark, raw, kept)
        return _sets[ident]


def upkept_table(name: str):
    """One ``t_*`` table that two refreshes have brought up to date."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _upkept(spark, sf_dir).t(name)
    return query


def upkept_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The financials that two refreshes have brought up to date."""
    return _upkept(spark, sf_dir).financials()


def landed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives whose headers differ by quarter, landed quarter by quarter of the year."""
    out = _scratch(spark, "headers-landed")
    archives = landing.list_archives(spark, _archive_set(spark, sf_dir, "headers"))
    for n in QUARTER_COLUMNS:
        landing.land_listed(archives.filter(F.col("srcdir").endswith(f"q{n}")), out)
    return landing.read_landed(spark, out, "num")


class _Killed(Exception):
    pass


def failed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first set, then a replacement by the second that dies when its rows are written: the first stays."""
    out = _scratch(spark, "failed")
    first, second = _archive_sets(spark, sf_dir)
    landing.land_archives(spark, first, out, mode="replace")

    def die():
        raise _Killed
    try:
        landing.land_archives(spark, second, out, mode="replace", before_commit=die)
    except _Killed:
        return landing.read_landed(spark, out, "num")
    raise AssertionError("the landing should have died")


def landed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sets appended: every row of every archive, each read by its own header."""
    out = _scratch(spark, "append")
    for folder in _archive_sets(spark, sf_dir):
        landing.land_archives(spark, folder, out, mode="append")
    return landing.read_landed(spark, out, "num")


def landed_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second set, then the first, leaving what is there: quarter 3 keeps the rows of the
    archive that comes first by path."""
    out = _scratch(spark, "skip")
    for folder in reversed(_archive_sets(spark, sf_dir)):
        landing.land_archives(spark, folder, out, mode="skip")
    return landing.read_landed(spark, out, "num")


def landed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first set, replaced by the second: quarters 1 and 2 become empty, quarter 3 holds
    the archive that comes last by path."""
    out = _scratch(spark, "replace")
    for folder in _archive_sets(spark, sf_dir):
        landing.land_archives(spark, folder, out, mode="replace")
    return landing.read_landed(spark, out, "num")


def landed_stream(max_files: int):
    """The two sets through the file stream, one run each, by ``max_files`` archives a batch."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = _scratch(spark, "stream")
        for i, folder in enumerate(_archive_sets(spark, sf_dir)):
            start_incremental_landing(spark, folder, out, f"{out}-progress-{i}",
                                      max_files_per_trigger=max_files).awaitTermination()
        return landing.read_landed(spark, out, "num")
    return query


def seed_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ESG panel written as CSV and read as a seed (blank fields are NULL)."""
    path = _scratch(spark, "seed")
    DriverRaw(spark, sf_dir).esg_risk_factors.write.option("header", True).option("emptyValue", "").csv(path)
    return read_seed(spark, path, "esg_risk_factors")


def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filings mart of the staging layer, written and read back by name."""
    views.save_table(spark, FilingModels.from_driver(spark, sf_dir).stg_sub, "published_filings",
                     _scratch(spark, "published"))
    return spark.table("published_filings")


def user_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's view over published model names."""
    models = FilingModels.from_driver(spark, sf_dir)
    views.register_models(models, {"assets_usd"})
    return views.register_view(spark, *USER_VIEW)


def view_over_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored stack of views over published models, defined from the top down and read back from its folder."""
    folder = _scratch(spark, "views")
    ViewCatalog(spark, folder).define(VIEW_STACK)
    return ViewCatalog(spark, folder).query(FilingModels.from_driver(spark, sf_dir), "select * from margin_by_industry")


REGISTRY = {
    "A7_landed_append": landed_append, "A8_landed_skip": landed_skip, "A9_landed_replace": landed_replace,
    "A10_read_seed": seed_round, "A12_published_table": published_table, "A13_user_view": user_view,
    "A13_view_over_view": view_over_view,
    "N_landed_stream": landed_stream(10_000), "N_landed_stream_by_2": landed_stream(2), "N_landed_stream_by_1": landed_stream(1),
    "A1_archive_lines": archive_lines, "A2_landed_sub": landed_member("sub"), "A2_landed_num": landed_member("num"),
    "A2_landed_tag": landed_member("tag"), "A6_landed_columns": landed_columns, "A9_failed_replace": failed_replace,
}
