"""Metric extraction from long-form facts.

All six metrics come out of ONE filter and ONE aggregation over the facts:
the tag decides the metric (no tag belongs to two metrics), a per-metric
predicate applies ``qtrs`` / ``coreg`` / sign, and a single
``groupBy(metric, filing, ddate, uom).max(value)`` replaces twelve views.

The non-USD views keep a filing only when it has no USD row for that metric.
The source writes this as ``left join usd ... where x.ddate is null``; it is a
left anti join on (metric, adsh), done here as a window flag over the
aggregated rows (a filing's rows per metric are its distinct dates x units,
not its facts, so even a hot filing makes a small window group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tags import METRICS, MetricSpec
from .staging import is_annual

FILING_KEYS = ("adsh", "cik", "name", "sic", "fy")
VIEW_COLS = FILING_KEYS + ("ddate", "uom")


def metric_tags(specs=None) -> tuple:
    specs = specs or list(METRICS.values())
    return tuple(t for s in specs for t in s.tags)


def tag_spec_map(specs=None):
    """tag -> struct(metric, qtrs, positive) as one constant map literal.

    A single map lookup keeps the generated code small however many tags there
    are (a CASE over the lists is copied into every predicate that reads it)."""
    specs = specs or list(METRICS.values())
    kv = []
    for s in specs:
        for t in s.tags:
            kv += [F.lit(t), F.struct(F.lit(s.name).alias("metric"), F.lit(s.qtrs).alias("qtrs"),
                                      F.lit(s.positive).alias("positive"))]
    return F.create_map(*kv)


def qualifying_facts(facts: DataFrame, specs=None) -> DataFrame:
    """Typed facts that a metric reads, tagged with it, whatever filing they belong to."""
    specs = specs or list(METRICS.values())
    spec = F.try_element_at(tag_spec_map(specs), F.col("tag"))
    tagged = facts.filter(F.col("tag").isin(*metric_tags(specs))).withColumn("_spec", spec)
    keep = (F.col("qtrs") == F.col("_spec.qtrs")) & F.col("coreg").isNull() \
        & (~F.col("_spec.positive") | (F.col("value") > F.lit(0)))
    return tagged.filter(keep).withColumn("metric", F.col("_spec.metric")).drop("_spec")


def metric_facts(facts: DataFrame, specs=None) -> DataFrame:
    """Qualifying facts of annual filings tagged with their metric.

    ``facts`` is staged ``num`` joined to FY filings *with* filing attributes
    (``stg_num(..., with_filing=True)``)."""
    return qualifying_facts(facts.filter(is_annual()), specs)


def largest_values(tagged: DataFrame) -> DataFrame:
    """One row per (metric, filing, ddate, uom) with the largest value, plus
    ``has_usd``: whether the filing has any USD row for that metric."""
    agg = tagged.groupBy("metric", *VIEW_COLS).agg(F.max("value").alias("value"))
    w = Window.partitionBy("metric", "adsh")
    return agg.withColumn("has_usd", F.max(F.col("uom") == F.lit("USD")).over(w))


def metric_values(facts: DataFrame, specs=None) -> DataFrame:
    """``largest_values`` of the facts of annual filings that a metric reads."""
    return largest_values(metric_facts(facts, specs))


def split_currency(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(USD rows, non-USD rows of filings without a USD row)."""
    usd = values.filter(F.col("uom") == F.lit("USD"))
    xyz = values.filter((F.col("uom") != F.lit("USD")) & ~F.coalesce(F.col("has_usd"), F.lit(False)))
    return usd, xyz


def metric_view(values: DataFrame, name: str, currency: str) -> DataFrame:
    """The source's ``<metric>_usd`` / ``<metric>_xyz`` view for one metric."""
    usd, xyz = split_currency(values.filter(F.col("metric") == F.lit(name)))
    side = usd if currency == "usd" else xyz
    return side.select(*VIEW_COLS, F.col("value").alias(name))


def metric_view_direct(facts: DataFrame, spec: MetricSpec, currency: str) -> DataFrame:
    """Per-view form (one metric, one pass): kept to cross-check the single pass."""
    return metric_view(metric_values(facts, [spec]), spec.name, currency)
