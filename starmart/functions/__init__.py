from starmart.functions.dates import month_of, months_apart, timestamp_literal
from starmart.functions.keys import key_bytes, key_sql, member_key_sql, surrogate_key
from starmart.functions.numbers import percent_half_up, ratio, unit_margin_sql
from starmart.functions.text import clean, clean_lower

__all__ = [
    "clean",
    "clean_lower",
    "key_bytes",
    "key_sql",
    "member_key_sql",
    "month_of",
    "months_apart",
    "percent_half_up",
    "ratio",
    "surrogate_key",
    "timestamp_literal",
    "unit_margin_sql",
]
