"""Typed staging of the raw relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import blank_to_null, fix_ddate, to_bool, yyyy, yyyymmdd
from ..functions.tags import ANNUAL_FORMS, ANNUAL_FROM
from ..plans.sizing import broadcast_if_small


def stg_sub(sub: DataFrame, truthy=("true",)) -> DataFrame:
    """Submissions with types; rows without fiscal year or period are dropped."""
    keep = (F.coalesce(F.col("fy"), F.lit("")) != F.lit("")) & \
           (F.coalesce(F.col("period"), F.lit("")) != F.lit(""))
    return sub.filter(keep).select(
        "adsh",
        F.col("cik").try_cast("bigint").alias("cik"),
        "name",
        blank_to_null("sic").try_cast("int").alias("sic"),
        blank_to_null("ein").try_cast("bigint").alias("ein"),
        "form",
        "fp",
        yyyymmdd("period").alias("period"),
        yyyy("fy").alias("fy"),
        yyyymmdd("filed").alias("filed"),
        blank_to_null("accepted").alias("accepted_raw"),
        to_bool("wksi", truthy).alias("wksi"),
        to_bool("prevrpt", truthy).alias("prevrpt"),
        to_bool("detail", truthy).alias("detail"),
        "srcdir",
    )


def typed_num(num: DataFrame, tags=None) -> DataFrame:
    """Facts with types. ``tags`` prunes to the tags a consumer reads; the
    ``IN`` filter runs in the scan stage, before any exchange."""
    if tags is not None:
        num = num.filter(F.col("tag").isin(*tags))
    return num.select(
        "adsh", "tag", "version",
        blank_to_null("coreg").alias("coreg"),
        yyyymmdd(fix_ddate("ddate")).alias("ddate"),
        F.col("qtrs").try_cast("int").alias("qtrs"),
        "uom",
        blank_to_null("value").try_cast("decimal(28,4)").alias("value"),
        blank_to_null("footnote").alias("footnote"),
        "srcdir",
    )


def fy_filings(stg_sub_df: DataFrame) -> DataFrame:
    """Filing attributes of FY filings: the right side of every fact join."""
    return stg_sub_df.filter(F.col("fp") == F.lit("FY")).select(
        "adsh", "fy", "fp", "cik", "name", "sic", "form")


FILINGS_BROADCAST_ROWS = 5_000_000  # and at most sizing.MAX_BROADCAST_BYTES


def stg_num(num: DataFrame, stg_sub_df: DataFrame, tags=None, with_filing: bool = False,
            max_broadcast_rows: int | None = FILINGS_BROADCAST_ROWS,
            distinct_filings: bool = False, keep: list | None = None) -> DataFrame:
    """Facts of FY filings (the source's left join + ``fp = 'FY'`` is an inner join).

    ``with_filing`` keeps cik/name/sic/form of the filing on every fact, so that the
    metric, FX and float consumers need no second join on ``adsh``.

    Filings are one row per submission, far fewer than facts.  When their count
    is under ``max_broadcast_rows`` they are broadcast and the facts are read in
    their natural splits: a filing that holds a third of all facts is spread
    over as many tasks as its files.  Above the limit the join is a shuffle
    sort-merge join, and AQE splits a hot adsh partition (the session sets
    ``spark.sql.adaptive.forceOptimizeSkewedJoin`` so the split is allowed even
    though the aggregate after it then needs its own exchange).

    ``distinct_filings`` joins one copy of each identical filing row.  A
    quarter loaded twice in append mode (or any group of copies) then cannot
    multiply the facts in the join.  Maxima are unaffected.  Rate means then
    weigh each fact once per fact copy instead of once per fact copy x filing
    copy, as SURVEY 7.4 decides.  Off for the staging view itself, which keeps
    the source's row multiplicity.  ``keep``: see ``broadcast_if_small``.
    """
    facts = typed_num(num, tags)
    right = fy_filings(stg_sub_df)
    if not with_filing:
        right = right.select("adsh", "fy", "fp")
    if distinct_filings:
        right = right.distinct()
    if max_broadcast_rows:
        right = broadcast_if_small(right, max_broadcast_rows, keep)
    return facts.join(right, "adsh", "inner")


def stg_tag(tag: DataFrame, truthy=("true",)) -> DataFrame:
    return tag.select(
        "tag", "version",
        to_bool("custom", truthy).alias("custom"),
        to_bool("abstract", truthy).alias("abstract"),
        blank_to_null("crdr").alias("crdr"),
        blank_to_null("tlabel").alias("tlabel"),
        blank_to_null("doc").alias("doc"),
        "srcdir",
    )


ESG_ID_COLS = ("isin", "cik", "gvkey", "cusip", "hqcountrycode", "year")


def isin_map(isin_cik: DataFrame) -> DataFrame:
    """``select distinct isin, cik`` with the char(10) cik cast to a number."""
    return isin_cik.select("isin", F.col("cik").try_cast("bigint").alias("cik")).distinct()


def stg_esg(esg: DataFrame, isin_cik: DataFrame, signals) -> DataFrame:
    """ESG panel left-joined to the distinct ISIN -> CIK map.

    The map has one row per security; it is joined with a shuffle-free broadcast
    only when Spark's size estimate allows it (AQE decides at runtime)."""
    m = isin_map(isin_cik)
    out = esg.join(m, "isin", "left")
    return out.select(*ESG_ID_COLS, *signals)


def is_annual() -> F.Column:
    """Annual forms from fiscal 2014 on (over ``form`` and typed ``fy``)."""
    return F.col("form").isin(*ANNUAL_FORMS) & (F.col("fy") >= F.lit(ANNUAL_FROM))


def annual_filings(stg_sub_df: DataFrame) -> DataFrame:
    return stg_sub_df.filter(is_annual())


def _reject(raw_col: str, parsed) -> F.Column:
    """Non-blank text that did not parse."""
    return F.when((F.coalesce(F.col(raw_col), F.lit("")) != F.lit("")) & parsed.isNull(), F.lit(raw_col))


def sub_checks() -> dict:
    """Column of the submissions -> its name where non-blank text does not parse."""
    return {"cik": _reject("cik", F.col("cik").try_cast("bigint")), "sic": _reject("sic", F.col("sic").try_cast("int")),
            "ein": _reject("ein", F.col("ein").try_cast("bigint")), "period": _reject("period", yyyymmdd("period")),
            "fy": _reject("fy", yyyy("fy")), "filed": _reject("filed", yyyymmdd("filed"))}


def num_checks() -> dict:
    """Column of the facts -> its name where non-blank text does not parse."""
    return {"ddate": _reject("ddate", yyyymmdd(fix_ddate("ddate"))), "qtrs": _reject("qtrs", F.col("qtrs").try_cast("int")),
            "value": _reject("value", F.col("value").try_cast("decimal(28,4)"))}


def _rejects(raw: DataFrame, checks: dict) -> DataFrame:
    bad = F.array_compact(F.array(*checks.values()))
    return raw.withColumn("rejected_columns", bad).filter(F.size("rejected_columns") > 0)


def sub_rejects(sub: DataFrame) -> DataFrame:
    """Submission rows whose non-blank cik/sic/ein/period/fy/filed text does not
    parse, with the offending columns (staging reads them as NULL)."""
    return _rejects(sub, sub_checks())


def num_rejects(num: DataFrame) -> DataFrame:
    """Fact rows whose non-blank ddate/qtrs/value text does not parse."""
    return _rejects(num, num_checks())


def observe_rejects(raw: DataFrame, checks: dict, name: str) -> tuple[DataFrame, Observation]:
    """``raw`` whose rows and rejected fields are counted as they pass, in the first job
    that reads it; no scan of their own."""
    seen = Observation(name)
    counts = [F.count(c).alias(column) for column, c in checks.items()]
    return raw.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts), seen


class RejectedRowsError(ValueError):
    pass


def assert_clean(rejects: DataFrame, table: str) -> None:
    """Strict mode: fail on the first row that does not parse."""
    row = rejects.select("rejected_columns").first()
    if row is not None:
        raise RejectedRowsError(f"{table}: values do not parse in columns {row['rejected_columns']}")
