"""Column-level helpers: every function returns a ``pyspark.sql.Column``.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation; no Python UDF is involved.
"""

from .buckets import bucket_right, haversine_km, ordinal, price_tier
from .dates import (age_years, calendar_parts, day_name, is_weekend, lenient_date,
                    lenient_date_of, month_name, year_month)
from .logic import bool_label, greater_than_flag, parse_bool, threshold_label
from .numeric import (human_money, log1p, mix32, pct_deviation, product, round_aggregate, round_even,
                      round_half_up,
                      row_mean, safe_ratio)
from .text import (NULL_TOKENS, fill_text, normalise_null_tokens, null_token, parse_currency,
                   parse_percent, text_length, title_case)

__all__ = [
    "bucket_right", "haversine_km", "ordinal", "price_tier",
    "age_years", "calendar_parts", "day_name", "is_weekend", "lenient_date", "lenient_date_of",
    "month_name", "year_month",
    "bool_label", "greater_than_flag", "parse_bool", "threshold_label",
    "human_money", "log1p", "mix32", "pct_deviation", "product", "round_aggregate", "round_even",
    "round_half_up",
    "row_mean", "safe_ratio",
    "NULL_TOKENS", "fill_text", "normalise_null_tokens", "null_token", "parse_currency",
    "parse_percent", "text_length", "title_case",
]
