from .columns import (blank_to_null, fix_ddate, parse_pair, base_currency, rate_to_usd,
                      prev_year_end, safe_ratio, to_bool, yyyymmdd, yyyy)
from .tags import METRICS, MetricSpec, FX_CLOSING_TAGS, FX_AVERAGE_TAGS, FLOAT_SHARE_TAGS, \
    FLOAT_PRICE_TAGS, FLOAT_REPORTED_TAGS, ANNUAL_FORMS, ANNUAL_FROM

__all__ = [
    "blank_to_null", "fix_ddate", "parse_pair", "base_currency", "rate_to_usd", "prev_year_end",
    "safe_ratio", "to_bool", "yyyymmdd", "yyyy", "METRICS", "MetricSpec", "FX_CLOSING_TAGS",
    "FX_AVERAGE_TAGS", "FLOAT_SHARE_TAGS", "FLOAT_PRICE_TAGS", "FLOAT_REPORTED_TAGS",
    "ANNUAL_FORMS", "ANNUAL_FROM",
]
