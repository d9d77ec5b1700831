"""Exchange rates derived from the filings themselves.

Closing (point in time) and average (four quarter) rates come out of one
filter + one aggregation over the facts: ``kind`` tells them apart.  The result
is bounded by currencies x dates, i.e. it does not grow with the fact count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import base_currency, has_pair, parse_pair, rate_to_usd
from ..functions.tags import FX_AVERAGE_TAGS, FX_CLOSING_TAGS, FX_FROM

CLOSING, AVERAGE = "closing", "average"


def fx_quotes(facts: DataFrame) -> DataFrame:
    """Rate facts with base currency and USD-per-base rate, one row per fact.

    A unit without a currency pair is removed (the source's set-returning
    regexp), which also removes bare three-letter units."""
    kind = (F.when((F.col("qtrs") == 0) & F.col("tag").isin(*FX_CLOSING_TAGS), F.lit(CLOSING))
             .when((F.col("qtrs") == 4) & F.col("tag").isin(*FX_AVERAGE_TAGS), F.lit(AVERAGE)))
    u = F.col("uom")
    cond = ((F.col("ddate") >= F.lit(FX_FROM)) & F.col("value").isNotNull() & (u != F.lit("USD"))
            & (u.like("%USD%") | (F.length(u) == 3)) & has_pair(u))
    c1, c2 = parse_pair(u)
    return (facts.filter(F.col("tag").isin(*(FX_CLOSING_TAGS + FX_AVERAGE_TAGS)))
            .withColumn("kind", kind)
            .filter(F.col("kind").isNotNull() & cond)
            .withColumns({"_c1": c1, "_c2": c2})
            .select("kind", base_currency("_c1", "_c2").alias("base"), "ddate",
                    rate_to_usd("_c1", F.col("value")).alias("rate_to_usd")))


RATE_TYPE = "decimal(38,20)"  # 20 places: every digit of a double rate of 1e-5 or more
SUM_LIMIT = 9e17  # sums below this surely fit RATE_TYPE


def exact_mean(rate) -> F.Column:
    """Mean of rates summed as decimals: a double rate is taken with all its digits
    and the sum does not depend on the order of the rows.  Sums too large for the type are made of
    whole parts and fractions apart, neither of which can overflow; only a group with
    a rate too large for the type itself (1e18) is averaged as doubles."""
    units = rate.try_cast(RATE_TYPE)
    n = F.count(units)
    whole = F.floor(units)  # decimal(19,0): sums of 10^19 rows fit
    fraction = (units - whole).cast("decimal(28,20)")
    wide = F.try_sum(whole).cast("double") / n + F.try_sum(fraction).cast("double") / n
    fits = F.max(F.abs(rate)) * n < F.lit(SUM_LIMIT)
    total = F.try_sum(units)
    rough = total.cast("double") / n
    # the quotient has 20 places too, so it is rounded once to a double where these are digits enough
    mean = F.when(F.abs(rough) >= F.lit(1e-5), F.try_divide(total, n.cast("decimal(20,0)")).cast("double")).otherwise(rough)
    exact = F.when(fits, mean).otherwise(wide)
    return F.when(n == F.count(rate), exact).otherwise(F.avg(rate))


def mean_rates(quotes: DataFrame) -> DataFrame:
    """(kind, base, ddate) -> to_usd = mean rate, from_usd = 1 / to_usd."""
    agg = quotes.groupBy("kind", "base", "ddate").agg(exact_mean(F.col("rate_to_usd")).alias("to_usd"))
    return agg.withColumn("from_usd", F.try_divide(F.lit(1.0), F.col("to_usd")))


def fx_rates(facts: DataFrame) -> DataFrame:
    return mean_rates(fx_quotes(facts))


def closing_fx(facts: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    r = rates if rates is not None else fx_rates(facts)
    return r.filter(F.col("kind") == CLOSING).select("base", "ddate", "to_usd", "from_usd")


def average_fx(facts: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    r = rates if rates is not None else fx_rates(facts)
    return r.filter(F.col("kind") == AVERAGE).select("base", "ddate", "to_usd", "from_usd")
