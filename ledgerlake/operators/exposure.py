"""Asset-weighted climate exposure by industry.

The source pairs every ESG row of a firm with every asset row of the firm
(no year in the key) and takes  sum(x * assets) / sum(assets)  per industry.
Both sums factor over firms:
    sum over pairs x_e * a_f = sum over firms (sum_e x_e) * (sum_f a_f)
    sum over pairs a_f       = sum over firms  n_e        * (sum_f a_f)
so each side is pre-aggregated to one row per firm (per firm and industry on
the asset side) before the join: no pair is materialised and a firm with a
third of all rows costs one partial aggregate, not a quadratic join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def asset_weighted_exposure(esg: DataFrame, assets_usd: DataFrame, signal: str = "ph_expo_ew",
                            esg_key: str = "cik", year: int | None = None,
                            with_firm_count: bool = True,
                            out_industry: str = "industry_code",
                            out_value: str = "asset_weighted_physical_climate_change_exposure",
                            require_positive_assets: bool = True,
                            drop_null_signal: bool = True, match_year: bool = False) -> DataFrame:
    """Weighted mean of ``signal`` per industry; ``drop_null_signal=False`` keeps
    rows with a NULL signal in the weight (their products are NULL and skipped
    by the numerator sum), which is what the side-project query does.
    ``match_year=True`` pairs an ESG year only with asset rows of the same
    fiscal year (the source pairs every year with every asset row)."""
    e = esg.filter(F.col(signal).isNotNull()) if drop_null_signal else esg
    if year is not None:
        e = e.filter(F.col("year") == F.lit(year))
    keys = ["cik", "_year"] if match_year else ["cik"]
    e_year = [F.col("year").alias("_year")] if match_year else []
    a_year = [F.year("fy").alias("_year")] if match_year else []
    e = (e.select(F.col(esg_key).try_cast("bigint").alias("cik"), *e_year, F.col(signal).alias("x"))
          .groupBy(*keys).agg(F.sum("x").alias("sum_x"), F.count(F.lit(1)).alias("n_e")))
    a = assets_usd
    if require_positive_assets:
        a = a.filter(F.col("assets") > F.lit(0))
    a = (a.select("cik", "sic", *a_year, F.col("assets").cast("double").alias("a"))
          .groupBy(*keys, "sic").agg(F.sum("a").alias("sum_a")))
    pairs = e.join(a, keys, "inner")
    num = F.sum(F.col("sum_x") * F.col("sum_a"))
    den = F.sum(F.col("n_e") * F.col("sum_a"))
    aggs = [F.try_divide(num, den).alias(out_value)]
    if with_firm_count:
        aggs.append(F.count_distinct("cik").alias("firm_count"))
    return pairs.groupBy(F.col("sic").alias(out_industry)).agg(*aggs)


def exposure_by_industry(esg_seed: DataFrame, assets_usd: DataFrame, year: int = 2024,
                         signal: str = "cc_expo_ew") -> DataFrame:
    """Side-project variant: gvkey as the firm key, one ESG year, cc exposure."""
    return asset_weighted_exposure(esg_seed, assets_usd, signal=signal, esg_key="gvkey", year=year,
                                   with_firm_count=False, out_industry="industry",
                                   out_value="asset_weighted_exposure",
                                   require_positive_assets=False, drop_null_signal=False)


def daily_totals(orders: DataFrame, ts_col: str = "o_orderdate", amount_col: str = "o_totalprice") -> DataFrame:
    """``sum(amount)`` per day of an order timestamp."""
    return (orders.groupBy(F.to_date(F.date_trunc("day", F.col(ts_col))).alias("order_date"))
            .agg(F.sum(amount_col).alias("total_amount")))
