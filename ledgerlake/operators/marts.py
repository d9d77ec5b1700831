"""Company financials mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tags import ANNUAL_FORMS

FIN_COLS = ("name", "cik", "fy", "ddate", "sic", "revenue_usd", "income_usd", "market_cap_usd",
            "debt_usd", "cash_usd", "assets_usd")


def financials(t: dict, stg_sub_df: DataFrame, dedupe: bool = False) -> DataFrame:
    """Revenue rows with income/debt/cash/assets matched on (cik, ddate) and
    float on (cik, fy).

    ``t`` maps metric name -> its ``t_*`` table.  Parity (``dedupe=False``)
    keeps the source's inner join to every annual filing of the firm-year,
    which repeats rows.  ``dedupe=True`` turns that join into a semi join and
    keeps one row per (cik, fy).

    The two joins on (cik, fy) come first, then the four on (cik, ddate), so the
    revenue rows move at most twice.  Annual filings are counted per firm-year
    before their join and rows are repeated at the very end, so no join carries
    the repeated rows."""
    r = t["revenue"].select("name", "cik", "fy", "ddate", "sic", "revenue_usd")
    filings = (stg_sub_df.filter(F.col("form").isin(*ANNUAL_FORMS)).groupBy("cik", "fy")
               .agg(F.count(F.lit(1)).cast("int").alias("_filings")))
    out = r.join(filings, ["cik", "fy"], "inner")

    def side(name, key):
        return t[name].select("cik", key, F.col(f"{name}_usd").alias(f"_{name}"))

    out = out.join(side("float", "fy"), ["cik", "fy"], "left")
    out = out.join(side("income", "ddate"), ["cik", "ddate"], "left")
    out = out.join(side("debt", "ddate"), ["cik", "ddate"], "left")
    out = out.join(side("cash", "ddate"), ["cik", "ddate"], "left")
    out = out.join(side("assets", "ddate"), ["cik", "ddate"], "left")
    if not dedupe:
        out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_filings"))))
    out = out.select("name", "cik", "fy", "ddate", "sic", "revenue_usd",
                     F.col("_income").alias("income_usd"), F.col("_float").alias("market_cap_usd"),
                     F.col("_debt").alias("debt_usd"), F.col("_cash").alias("cash_usd"),
                     F.col("_assets").alias("assets_usd"))
    if dedupe:
        w = Window.partitionBy("cik", "fy").orderBy(
            F.col("ddate").desc_nulls_first(), F.col("revenue_usd").desc_nulls_last(),
            F.col("income_usd").desc_nulls_last(), F.col("market_cap_usd").desc_nulls_last(),
            F.col("debt_usd").desc_nulls_last(), F.col("cash_usd").desc_nulls_last(),
            F.col("assets_usd").desc_nulls_last(), F.col("name").asc_nulls_last())
        out = out.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    return out
