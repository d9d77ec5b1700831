"""Registered queries: id -> (spark, sf_dir) -> DataFrame.

Ids follow the operator inventory.  Each query builds its own plan over the
raw filing tables derived from the driver tables of ``sf_dir``; those are
landed once per application (``DriverRaw``), everything else is rebuilt per
call.  Doubles listed per query are reduced to 12 significant digits for the
engine-to-engine comparison (``sig``), exactly as the SQL oracle does; the
library functions themselves return full precision.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import METRICS
from ..operators import exposure, fx, kpis, text_signals
from ..session import checkpoint_dir
from ..sources.adapter import DirtyRaw, DriverRaw, read_driver
from ..sources import landing
from . import landing_queries
from .models import FilingModels

MONEY = ("revenue_usd", "income_usd", "market_cap_usd", "debt_usd", "cash_usd", "assets_usd")
METRIC_IDS = {"assets": (1, 9), "cash": (3, 10), "debt": (5, 11), "float": (7, 12),
              "revenue": (9, 13), "income": (11, 14)}


SIG_PATTERN = "0.00000000000E0"  # 12 significant digits
#: Amounts are products of short decimals, so many end in an exact half at the 12th digit, where the
#: last bit of a mean decides.  Both engines move values up by 3e-14 of themselves before rounding.
SIG_NUDGE = 1.00000000000003


def sig(c) -> F.Column:
    """12 significant digits, rounded half-even on the exact binary value
    (DecimalFormat), which is what C's ``%.11e`` does on the oracle side."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.call_function("format_number", c * F.lit(SIG_NUDGE), F.lit(SIG_PATTERN)).cast("double"))


def with_sig(df: DataFrame, doubles) -> DataFrame:
    return df.withColumns({c: sig(c) for c in doubles}) if doubles else df


def _m(spark, sf_dir) -> FilingModels:
    return FilingModels.from_driver(spark, sf_dir)


def _dirty(spark, sf_dir) -> FilingModels:
    return FilingModels(spark, DirtyRaw(spark, sf_dir))


def _reject_counts(spark, sf_dir) -> DataFrame:
    """Values of the faulty facts that do not parse, counted by the job that writes the staging model."""
    models = FilingModels(spark, DirtyRaw(spark, sf_dir), count_rejects=True)
    models.stg_num.write.parquet(f"{checkpoint_dir(spark).rstrip('/')}/counted-{uuid.uuid4().hex}")
    counts = models.reject_counts()["num"]
    return spark.createDataFrame([(c, n, counts["n_rows"]) for c, n in counts.items() if c != "n_rows"],
                                 "column_name string, n_rejected long, n_rows long")


def _metric_queries() -> dict:
    out = {}
    for spec in METRICS.values():
        e, f = METRIC_IDS[spec.name]
        n = spec.name
        out[f"E{e}_{n}_usd"] = (lambda s, d, n=n: _m(s, d).metric_view(n, "usd"), ())
        out[f"E{e + 1}_{n}_xyz"] = (lambda s, d, n=n: _m(s, d).metric_view(n, "xyz"), ())
        out[f"F{f}_t_{spec.short}"] = (lambda s, d, n=n: _m(s, d).t(n), (f"{n}_usd",))
    return out


def _lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines made from lineitem: 2..8 fields, some with a trailing CR."""
    li = read_driver(spark, sf_dir, "lineitem")
    fields = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey",
                                                 "l_linenumber", "l_returnflag", "l_linestatus",
                                                 "l_shipdate", "l_quantity")]
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 7 + 2
    arr = F.slice(F.array(*fields), 1, k.cast("int"))
    line = F.concat(F.array_join(arr, "\t"),
                    F.when(F.col("l_linenumber") % 3 == 0, F.lit("\r")).otherwise(F.lit("")))
    return li.select("l_orderkey", "l_linenumber", line.alias("line"))


# two quarters whose headers differ (schema evolution)
EVOLVING_HEADERS = {"2020q1": ["orderkey", "partkey", "suppkey", "linenumber", "rest"],
                    "2020q2": ["orderkey", "partkey", "extra", "linenumber"]}


def _evolve_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of even orders belong to an archive with one header, odd
    orders to one with another; rows come out with the union of columns."""
    lines = _lineitem_lines(spark, sf_dir).select(
        F.when(F.col("l_orderkey") % 2 == 0, F.lit("2020q1")).otherwise(F.lit("2020q2")).alias("srcdir"),
        F.lit("num").alias("table"), F.col("l_linenumber").cast("long").alias("line_no"), "line")
    headers = spark.createDataFrame([(k, "num", v) for k, v in EVOLVING_HEADERS.items()],
                                    "srcdir string, table string, header array<string>")
    columns = []
    for h in EVOLVING_HEADERS.values():
        columns += [c for c in h if c not in columns]
    return landing.rows_for_table(lines, headers, "num", columns)


def _normalize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5 over lines made from lineitem: 2..8 tab-separated fields per line
    (some with a trailing CR), parsed against a 5-column header."""
    lines = _lineitem_lines(spark, sf_dir)
    header = ["orderkey", "partkey", "suppkey", "linenumber", "rest"]
    parsed = landing.parse_fixed_header(lines, "line", header)
    return parsed.select("l_orderkey", "l_linenumber", *header)


REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], tuple]] = {
    "B1_stg_sub": (lambda s, d: _m(s, d).stg_sub, ()),
    "B2_stg_num": (lambda s, d: _m(s, d).stg_num, ()),
    "B3_stg_tag": (lambda s, d: _m(s, d).stg_tag, ()),
    "B4_stg_esg": (lambda s, d: _m(s, d).stg_esg, ()),
    "D7_isin_map": (lambda s, d: DriverRaw(s, d).isin_cik.distinct(), ()),
    "F3_fx_quotes": (lambda s, d: fx.fx_quotes(_m(s, d).facts), ("rate_to_usd",)),
    "F4_closing_fx": (lambda s, d: _m(s, d).closing_fx, ("to_usd", "from_usd")),
    "F5_average_fx": (lambda s, d: _m(s, d).average_fx, ("to_usd", "from_usd")),
    **_metric_queries(),
    # products of exact inputs: bit-identical in both engines, compared as is
    "J1_float_candidates": (lambda s, d: _m(s, d).float_candidates, ()),
    "J2_float_inferred": (lambda s, d: _m(s, d).float_inferred, ()),
    "J3_float": (lambda s, d: _m(s, d).float_latest, ()),
    "J4_financials": (lambda s, d: _m(s, d).financials(), MONEY),
    "J4b_financials_dedup": (lambda s, d: _m(s, d).financials(dedupe=True), MONEY),
    "D3_asset_weighted_exposure": (lambda s, d: _m(s, d).exposure(),
                                   ("asset_weighted_physical_climate_change_exposure",)),
    "D4_physical_exposure": (lambda s, d: _m(s, d).exposure(),
                             ("asset_weighted_physical_climate_change_exposure",)),
    # the side project's literal year is 2024; the driver's ESG panel covers 2019-2021
    "D5_exposure_by_industry": (lambda s, d: _m(s, d).exposure_by_industry(year=2021),
                                ("asset_weighted_exposure",)),
    "D6_daily_order_totals": (lambda s, d: exposure.daily_totals(read_driver(s, d, "orders")),
                              ("total_amount",)),
    "K_kpis": (lambda s, d: _m(s, d).kpis(dedupe=True), kpis.KPI_COLS),
    "L_text_signals": (lambda s, d: text_signals.text_signals(read_driver(s, d, "conversations")),
                       tuple(f"{t}_{k}_ew" for t in text_signals.DEFAULT_TOPICS
                             for k in text_signals.KINDS)),
    "A5_normalize_rows": (_normalize_query, ()),
    "A6_evolve_schema": (_evolve_query, ()),
    "L1_transcript_signals": (lambda s, d: text_signals.transcript_signals(
        text_signals.conversation_transcripts(read_driver(s, d, "conversations")),
        ["conv_id", "firm_id", "year", "quarter"], "text"),
        tuple(f"{t}_{k}_ew" for t in text_signals.DEFAULT_TOPICS for k in text_signals.KINDS)),
    # tone lists of a real dictionary's length
    "L_large_lists": (lambda s, d: text_signals.transcript_signals(
        text_signals.conversation_transcripts(read_driver(s, d, "conversations")),
        ["conv_id", "firm_id", "year", "quarter"], "text",
        tone_words=text_signals.large_tone_lists(read_driver(s, d, "documents"))),
        tuple(f"{t}_{k}_ew" for t in text_signals.DEFAULT_TOPICS for k in text_signals.KINDS)),
    # rates whose sums need more than 38 digits
    "F4_wide_rates": (lambda s, d: fx.mean_rates(fx.fx_quotes(_m(s, d).facts).withColumn(
        "rate_to_usd", F.col("rate_to_usd") * F.lit(1e17))), ("to_usd", "from_usd")),
    "D3b_exposure_match_year": (lambda s, d: _m(s, d).exposure(match_year=True),
                                ("asset_weighted_physical_climate_change_exposure",)),
    "F9b_t_a_single_codes": (lambda s, d: FilingModels.from_driver(s, d, uom_mode="pair_or_single").t("assets"),
                             ("assets_usd",)),
    # the same models over raw rows with faults
    "B1_dirty": (lambda s, d: _dirty(s, d).stg_sub, ()),
    "B2_dirty": (lambda s, d: _dirty(s, d).stg_num, ()),
    "B2_rejects": (lambda s, d: _dirty(s, d).rejects_num.select("adsh", "tag", "ddate", "qtrs", "value"), ()),
    "E2_dirty": (lambda s, d: _dirty(s, d).metric_view("assets", "xyz"), ()),
    "F4_dirty": (lambda s, d: _dirty(s, d).closing_fx, ("to_usd", "from_usd")),
    "F9_dirty": (lambda s, d: _dirty(s, d).t("assets"), ("assets_usd",)),
    "J2_dirty": (lambda s, d: _dirty(s, d).float_inferred, ()),
    "J3_dirty": (lambda s, d: _dirty(s, d).float_latest, ()),
    **{k: (fn, ()) for k, fn in landing_queries.REGISTRY.items()},
    "B2_reject_counts": (_reject_counts, ()),
    "A12_upkept_t_a": (landing_queries.upkept_table("assets"), ("assets_usd",)),
    "A12_upkept_t_d": (landing_queries.upkept_table("debt"), ("debt_usd",)),
    "A12_upkept_financials": (landing_queries.upkept_financials, MONEY),
    "A11_financials_from_archives": (lambda s, d: landing_queries.models_from_archives(s, d).financials(), MONEY),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn, doubles):
        return lambda spark, sf_dir: with_sig(fn(spark, sf_dir), doubles)
    return {k: wrap(fn, dbl) for k, (fn, dbl) in REGISTRY.items()}
