"""Float inference and the latest-float mart.

Candidates: shares x price on the same filing, date and co-registrant, ranked
per filing by date desc, shares desc (ties: price desc, coreg, uom).  The
source joins every share fact to every price fact of a key and ranks all the
pairs.  Because the ranking is lexicographic, the best pair of a key is
(largest shares, largest price), so each side is reduced to one row per
(adsh, ddate, coreg) first and the join is 1:1: no pair explosion on a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tags import (COMPUTED_FLOAT_TAG, COMPUTED_SRCDIR, FLOAT_PRICE_TAGS,
                              FLOAT_REPORTED_TAGS, FLOAT_SHARE_TAGS)

INFERRED_COLS = ("adsh", "ddate", "uom", "coreg", "tag", "value", "qtrs", "srcdir")
_NO_COREG = "__"


def float_candidates(facts: DataFrame) -> DataFrame:
    """One computed market float per filing (``int_float_candidates``)."""
    base = facts.filter(F.col("value") > F.lit(0)).filter(F.col("ddate").isNotNull()) \
                .withColumn("ckey", F.coalesce(F.col("coreg"), F.lit(_NO_COREG)))
    shares = (base.filter(F.col("tag").isin(*FLOAT_SHARE_TAGS))
              .groupBy("adsh", "ddate", "ckey")
              .agg(F.max("value").alias("shares_out"),
                   # unit of the largest share fact; smallest unit on ties
                   F.min_by("uom", F.struct((-F.col("value")).alias("v"), F.col("uom").alias("u")))
                   .alias("s_uom"),
                   F.first("coreg", ignorenulls=True).alias("s_coreg")))
    prices = (base.filter(F.col("tag").isin(*FLOAT_PRICE_TAGS))
              .groupBy("adsh", "ddate", "ckey")
              .agg(F.max("value").alias("price_per_share"),
                   # unit of the largest price fact; smallest unit on ties
                   F.min_by("uom", F.struct((-F.col("value")).alias("v"), F.col("uom").alias("u")))
                   .alias("p_uom"),
                   F.first("coreg", ignorenulls=True).alias("p_coreg")))
    sv = shares.join(prices, ["adsh", "ddate", "ckey"], "inner").select(
        "adsh", "ddate", "shares_out", "price_per_share",
        F.coalesce("s_coreg", "p_coreg").alias("coreg"),
        F.coalesce("s_uom", "p_uom").alias("uom"))
    w = Window.partitionBy("adsh").orderBy(
        F.col("ddate").desc_nulls_first(), F.col("shares_out").desc_nulls_first(),
        F.col("price_per_share").desc_nulls_first(), F.col("coreg").asc_nulls_first(),
        F.col("uom").asc_nulls_first())
    ranked = sv.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)
    return ranked.select(
        "adsh", "ddate", "uom", "coreg",
        F.lit(COMPUTED_FLOAT_TAG).alias("tag"),
        (F.col("shares_out").cast("double") * F.col("price_per_share").cast("double")).alias("value"),
        F.lit(0).alias("qtrs"),
        F.lit(COMPUTED_SRCDIR).alias("srcdir"))


def float_inferred(facts: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Reported float facts (no unit, sign or co-registrant filter) plus computed ones."""
    cand = candidates if candidates is not None else float_candidates(facts)
    reported = facts.filter(F.col("tag").isin(*FLOAT_REPORTED_TAGS)).select(
        "adsh", "ddate", "uom", "coreg", "tag", F.col("value").cast("double").alias("value"),
        "qtrs", "srcdir")
    return reported.unionByName(cand.select(*INFERRED_COLS))


def float_latest(inferred: DataFrame, stg_sub_df: DataFrame) -> DataFrame:
    """Latest float per company (``float`` mart; named _usd but not converted).
    Filing copies are joined once: they could only repeat the same candidates."""
    s = stg_sub_df.select("adsh", "cik", "name").distinct()
    base = inferred.join(s, "adsh", "inner")
    w = Window.partitionBy("cik").orderBy(
        F.col("ddate").desc_nulls_first(), F.col("adsh").asc(), F.col("tag").asc(),
        F.col("uom").asc(), F.col("value").desc_nulls_last())
    ranked = base.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)
    return ranked.select("cik", F.col("name").alias("company_name"),
                         F.col("value").alias("latest_float_value_usd"),
                         F.col("ddate").alias("last_ddate"))
