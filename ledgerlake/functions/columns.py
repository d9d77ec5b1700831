"""Column -> Column helpers (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tags import BAD_DDATES, CURRENCY_PAIR_PATTERN


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x) -> Column:
    """``nullif(x, '')``."""
    x = _c(x)
    return F.when(x != F.lit(""), x)


def fix_ddate(x) -> Column:
    """Replace the known mistyped fact dates (text in, text out)."""
    x = _c(x)
    out = x
    for bad, good in reversed(list(BAD_DDATES.items())):
        out = F.when(x == F.lit(bad), F.lit(good)).otherwise(out)
    return out


def yyyymmdd(x) -> Column:
    """Text ``yyyyMMdd`` -> date; malformed or blank -> NULL."""
    return F.try_to_date(blank_to_null(x), "yyyyMMdd")


def yyyy(x) -> Column:
    """Text ``yyyy`` -> 1 January of that year."""
    return F.try_to_date(blank_to_null(x), "yyyy")


def to_bool(x, truthy=("true",)) -> Column:
    """``x = 'true'`` (NULL stays NULL). ``truthy`` widens the accepted spellings."""
    x = _c(x)
    if len(truthy) == 1:
        return x == F.lit(truthy[0])
    return x.isin(*truthy)


def parse_pair(uom) -> tuple[Column, Column]:
    """First two three-capital groups of a unit, NULL when there is no pair."""
    u = _c(uom)
    c1 = F.regexp_extract(u, CURRENCY_PAIR_PATTERN, 1)
    c2 = F.regexp_extract(u, CURRENCY_PAIR_PATTERN, 2)
    return blank_to_null(c1), blank_to_null(c2)


def has_pair(uom) -> Column:
    return _c(uom).rlike(CURRENCY_PAIR_PATTERN)


def base_currency(c1, c2) -> Column:
    """The non-USD side of a pair."""
    c1, c2 = _c(c1), _c(c2)
    return F.when(c1 == F.lit("USD"), c2).otherwise(c1)


def rate_to_usd(c1, value) -> Column:
    """USD per unit of base: invert a USD/XXX quote; zero rates become NULL."""
    c1, v = _c(c1), _c(value).cast("double")
    return F.when(c1 == F.lit("USD"), F.try_divide(F.lit(1.0), v)).otherwise(v)


def prev_year_end(d) -> Column:
    """31 December of the previous calendar year."""
    d = _c(d)
    return F.make_date(F.year(d) - 1, F.lit(12), F.lit(31))


def safe_ratio(num, den) -> Column:
    """num / den as double; NULL for a NULL or zero denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
