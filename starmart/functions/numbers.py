"""Safe ratios and exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: str, denominator: str) -> Column:
    """Quotient of two SQL expressions as a double; NULL where the denominator is zero or a side is NULL."""
    return F.expr(f"try_divide(cast({numerator} as double), cast({denominator} as double))")


def unit_margin_sql() -> str:
    """Price less unit cost at nine decimals; operands are narrowed first, as Spark gives up scale beyond 38 digits."""
    return "cast(cast(price as decimal(28,9)) - cast(unit_cost as decimal(28,9)) as decimal(28,9))"


def percent_half_up(part: str, whole: str) -> Column:
    """``part / whole`` in percent, two decimals, half up; in whole numbers so no double rounds it."""
    return F.expr(f"double(({part} * 20000 + {whole}) div (2 * {whole})) / 100.0D")
