"""Financial and climate KPIs over the financials mart.

Ratios are ``try_divide``: NULL for a NULL or zero denominator.  Industry
benchmarks are averages over (sic) or (sic, fy).  They are computed as a
partially aggregated ``groupBy`` and joined back, rather than as a window:
a window over a low-cardinality key puts a whole industry into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_ratio
from ..plans.sizing import broadcast_if_small

# name -> (numerator, denominator) over financials columns
RATIOS = {
    "profit_margin": ("income_usd", "revenue_usd"),
    "return_on_assets_roa": ("income_usd", "assets_usd"),
    "debt_to_assets_ratio": ("debt_usd", "assets_usd"),
    "market_cap_to_revenue": ("market_cap_usd", "revenue_usd"),
    "cash_ratio": ("cash_usd", "debt_usd"),
    "asset_turnover_ratio": ("revenue_usd", "assets_usd"),
    "cash_to_assets_ratio": ("cash_usd", "assets_usd"),
    "income_to_market_cap_ratio": ("income_usd", "market_cap_usd"),
    "revenue_to_assets_ratio": ("revenue_usd", "assets_usd"),
    "debt_to_revenue_ratio": ("debt_usd", "revenue_usd"),
}

# name -> (base ratio, benchmark keys)
RELATIVE = {
    "relative_profit_margin": ("profit_margin", ("sic", "fy")),
    "relative_return_on_assets_roa": ("return_on_assets_roa", ("sic",)),
    "relative_debt_ratio": ("debt_to_assets_ratio", ("sic",)),
    "liquidity_index": ("cash_ratio", ("sic", "fy")),
}

# name -> (financials column or ratio, ESG signal)
CLIMATE = {
    "revenue_per_climate_risk": ("revenue_usd", "cc_risk_ew"),
    "market_cap_per_esg_opportunity": ("market_cap_usd", "op_expo_ew"),
    "profit_margin_per_climate_exposure": ("profit_margin", "cc_expo_ew"),
    "cash_resilience_to_physical_risk": ("cash_usd", "ph_risk_ew"),
}


def ratio_kpis(fin: DataFrame) -> DataFrame:
    return fin.select("*", *[safe_ratio(n, d).alias(k) for k, (n, d) in RATIOS.items()])


def industry_benchmarks(kp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean of each benchmarked ratio per (sic, fy) and per (sic).

    One partially aggregated pass over the KPI rows yields sums and counts per
    (sic, fy); the (sic) means are rolled up from those partials.  Both results
    are bounded by industries x years, not by the number of filings."""
    aggs = []
    for _, (base, _keys) in RELATIVE.items():
        aggs += [F.sum(base).alias(f"_s_{base}"), F.count(base).alias(f"_n_{base}")]
    g = kp.groupBy("sic", "fy").agg(*aggs)
    by_sic_fy = g.select("sic", "fy", *[
        F.try_divide(F.col(f"_s_{b}"), F.col(f"_n_{b}").cast("double")).alias(f"_avg_{n}")
        for n, (b, keys) in RELATIVE.items() if keys == ("sic", "fy")])
    by_sic = g.groupBy("sic").agg(*[
        F.try_divide(F.sum(f"_s_{b}"), F.sum(f"_n_{b}").cast("double")).alias(f"_avg_{n}")
        for n, (b, keys) in RELATIVE.items() if keys == ("sic",)])
    return by_sic_fy, by_sic


def relative_kpis(kp: DataFrame, max_broadcast_rows: int = 1_000_000, keep: list | None = None) -> DataFrame:
    """Each relative KPI = ratio / mean of the ratio over its industry group.

    The group means are joined back null-safely (a NULL industry is a group,
    as in a window) and broadcast after a size check: the KPI rows themselves
    are never shuffled by industry, so a dominant industry costs nothing extra."""
    by_sic_fy, by_sic = industry_benchmarks(kp)
    b1 = broadcast_if_small(by_sic_fy.withColumnsRenamed({"sic": "_b1_sic", "fy": "_b1_fy"}),
                            max_broadcast_rows, keep)
    b2 = broadcast_if_small(by_sic.withColumnRenamed("sic", "_b2_sic"), max_broadcast_rows, keep)
    out = kp.join(b1, kp["sic"].eqNullSafe(b1["_b1_sic"]) & kp["fy"].eqNullSafe(b1["_b1_fy"]), "left")
    out = out.join(b2, out["sic"].eqNullSafe(b2["_b2_sic"]), "left")
    out = out.withColumns({name: F.try_divide(F.col(base), F.col(f"_avg_{name}"))
                           for name, (base, _keys) in RELATIVE.items()})
    return out.drop("_b1_sic", "_b1_fy", "_b2_sic", *[f"_avg_{n}" for n in RELATIVE])


def climate_kpis(kp: DataFrame, esg: DataFrame, max_broadcast_rows: int = 2_000_000,
                 keep: list | None = None) -> DataFrame:
    """Join the ESG panel on (cik, year of fy) and divide by the signal.

    ESG is reduced to one row per firm-year first (a security map may list a
    firm twice), so the join cannot repeat financial rows; the panel is a
    firm-year table and is broadcast after a size check."""
    signals = sorted({s for _, s in CLIMATE.values()})
    e = (esg.filter(F.col("cik").isNotNull())
            .groupBy(F.col("cik").alias("_e_cik"), F.col("year").alias("_e_year"))
            .agg(*[F.avg(s).alias(s) for s in signals]))
    e = broadcast_if_small(e, max_broadcast_rows, keep)
    out = kp.join(e, (kp["cik"] == e["_e_cik"]) & (F.year(kp["fy"]) == e["_e_year"]), "left")
    out = out.withColumns({name: safe_ratio(num, sig) for name, (num, sig) in CLIMATE.items()})
    return out.drop("_e_cik", "_e_year", *signals)


KPI_COLS = tuple(RATIOS) + tuple(RELATIVE) + tuple(CLIMATE)


def all_kpis(fin: DataFrame, esg: DataFrame, max_broadcast_rows: int | None = None,
             keep: list | None = None) -> DataFrame:
    lim = {} if max_broadcast_rows is None else {"max_broadcast_rows": max_broadcast_rows}
    kp = relative_kpis(ratio_kpis(fin), keep=keep, **lim)
    kp = climate_kpis(kp, esg, keep=keep, **lim)
    return kp.select("cik", "fy", "ddate", "sic", *KPI_COLS)
