"""Best row per firm-year and conversion to US dollars.

For every metric at once:
  * best USD row and best non-USD row per (metric, cik, fy): latest ``ddate``
    (NULL first, as the source's DESC order does), ties by adsh, uom, value;
  * the non-USD row's unit is parsed; the rate comes from a fixed fallback
    order of seven lookups (closing at t, t-1m, t-2m, t-3m; average at t,
    t-1y, previous 31 December).

The seven lookups are ONE join: each row is exploded into its seven
(kind, base, date) candidates, joined to the rate table and folded back with
``min_by(rate, step)``.  The rate table is broadcast only after its row count
is checked; beyond the limit the same join runs as a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import base_currency, has_pair, parse_pair, prev_year_end
from ..functions.tags import METRICS
from ..plans.sizing import broadcast_if_small
from .fx import AVERAGE, CLOSING

OUT_COLS = ("adsh", "cik", "name", "sic", "fy", "ddate")
RATES_BROADCAST_ROWS = 2_000_000  # currencies x dates; ~100 MB


def rank_latest(df: DataFrame, keys=("metric", "cik", "fy")) -> DataFrame:
    """Top-1 per key by latest ddate (nulls first), deterministic ties.
    Catalyst turns ``row_number() ... = 1`` into a window group limit that also
    runs before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col("ddate").desc_nulls_first(), F.col("adsh").asc(),
                                          F.col("uom").asc(), F.col("value").desc_nulls_last())
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1).drop("rn")


def fx_candidates(df: DataFrame, only=None) -> DataFrame:
    """Seven (step, kind, fx_date) lookups per row, in fallback order.
    Rows where ``only`` is false keep one row with NULL lookups."""
    d = F.col("ddate")
    steps = [
        (0, CLOSING, d),
        (1, CLOSING, F.add_months(d, -1)),
        (2, CLOSING, F.add_months(d, -2)),
        (3, CLOSING, F.add_months(d, -3)),
        (4, AVERAGE, d),
        (5, AVERAGE, F.add_months(d, -12)),
        (6, AVERAGE, prev_year_end(d)),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(k).alias("kind"), c.alias("fx_date"))
                    for i, k, c in steps])
    if only is not None:
        arr = F.when(only, arr)
    return df.withColumn("cand", F.explode_outer(arr)).select("*", "cand.*").drop("cand")


def attach_rate(rows: DataFrame, rates: DataFrame, only=None,
                max_broadcast_rows: int = RATES_BROADCAST_ROWS, keep: list | None = None) -> DataFrame:
    """Add ``rate`` (USD per unit of ``base``, first step that has one) to each row.

    The rate table is (kind, base, ddate) -> to_usd.  Rows must be distinct."""
    keys = list(rows.columns)
    cand = fx_candidates(rows, only)
    r = rates.select(F.col("kind").alias("fx_kind"), F.col("base").alias("fx_base"),
                     F.col("ddate").alias("fx_day"), "to_usd")
    r = broadcast_if_small(r, max_broadcast_rows, keep)
    cond = ((cand["kind"] == r["fx_kind"]) & (cand["base"] == r["fx_base"])
            & (cand["fx_date"] == r["fx_day"]))
    joined = cand.join(r, cond, "left").select(*[cand[c] for c in keys], cand["step"], r["to_usd"])
    first_step = F.when(F.col("to_usd").isNotNull(), F.col("step"))
    return joined.groupBy(*keys).agg(F.min_by("to_usd", first_step).alias("rate"))


def converted_tables(values: DataFrame, rates: DataFrame, specs=None,
                     max_broadcast_rows: int = RATES_BROADCAST_ROWS, uom_mode: str = "pair",
                     keep: list | None = None, lookups: DataFrame | None = None) -> DataFrame:
    """All six ``t_*`` tables in one frame:
    metric, adsh, cik, name, sic, fy, ddate, amount_usd.

    One exchange: the top-1 window on (metric, side, cik, fy); the rate join is
    map-side (broadcast) and the fold-back aggregate reuses the window's
    partitioning.

    ``uom_mode='pair'`` is the source's behaviour: only a currency pair
    (``EURUSD``, ``USD/JPY``) names a base currency, so single codes never
    convert.  ``'pair_or_single'`` also reads a bare three-letter unit
    (``EUR``) as its own base currency.

    ``lookups``: every (base, ddate) that the rows may look up, where a caller has them.  Each is then looked up once
    (they are currencies x dates) and its rate joined to the rows, instead of seven lookups for every row."""
    if uom_mode not in ("pair", "pair_or_single"):
        raise ValueError(f"unknown uom_mode {uom_mode}")
    specs = specs or list(METRICS.values())
    names = [s.name for s in specs]
    drop_metrics = [s.name for s in specs if s.no_match == "drop"]
    u = F.col("uom")
    side = (F.when(u == F.lit("USD"), F.lit("usd"))
             .when((u != F.lit("USD")) & ~F.coalesce(F.col("has_usd"), F.lit(False)), F.lit("xyz")))
    rows = values.filter(F.col("metric").isin(*names)).withColumn("side", side) \
                 .filter(F.col("side").isNotNull())
    best = rank_latest(rows, keys=("metric", "side", "cik", "fy"))
    is_xyz = F.col("side") == F.lit("xyz")
    single = u.rlike(r"^[A-Z]{3}$") if uom_mode == "pair_or_single" else F.lit(False)
    if drop_metrics:
        # the unit is parsed after the top-1 pick: a dropped best row is not replaced
        best = best.filter(~(is_xyz & F.col("metric").isin(*drop_metrics) & ~(has_pair(u) | single)))
    c1, c2 = parse_pair(u)
    best = best.withColumns({"_c1": c1, "_c2": c2})  # parse once; base reads the parts
    base = F.when(single, u).otherwise(base_currency(F.col("_c1"), F.col("_c2")))
    best = best.select("metric", "side", *OUT_COLS, "value", F.when(is_xyz, base).alias("base"))
    if lookups is None:
        rated = attach_rate(best, rates, only=is_xyz, max_broadcast_rows=max_broadcast_rows, keep=keep)
    else:
        r = attach_rate(lookups.distinct(), rates, max_broadcast_rows=max_broadcast_rows, keep=keep)
        r = broadcast_if_small(r.toDF("fx_base", "fx_day", "rate"), max_broadcast_rows, keep)
        rated = best.join(r, (best["base"] == r["fx_base"]) & (best["ddate"] == r["fx_day"]), "left")
    amount = F.when(is_xyz, F.col("rate") * F.col("value").cast("double")) \
              .otherwise(F.col("value").cast("double"))
    return rated.select("metric", *OUT_COLS, amount.alias("amount_usd"))


def t_table(converted: DataFrame, name: str) -> DataFrame:
    """One ``t_*`` table: adsh, cik, name, sic, fy, ddate, <metric>_usd."""
    return converted.filter(F.col("metric") == F.lit(name)) \
                    .select(*OUT_COLS, F.col("amount_usd").alias(f"{name}_usd"))
