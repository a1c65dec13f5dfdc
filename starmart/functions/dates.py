"""Calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(column: str | Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(F.col(column) if isinstance(column, str) else column, "month")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates, whatever their days."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def timestamp_literal(value: dt.datetime) -> Column:
    """A timestamp constant; a value without a zone is read in the session time zone, not the driver's."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")
