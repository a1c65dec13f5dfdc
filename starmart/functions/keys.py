"""Surrogate keys: a hash of the natural key, the same in every table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_sql(*parts: str) -> str:
    """The key as SQL text; a key of literals is folded to a constant."""
    shown = ", ".join(f"coalesce(cast({part} as string), '_null_')" for part in parts)
    return f"md5(concat_ws('-', {shown}))"


def surrogate_key(*columns: str) -> Column:
    return F.expr(key_sql(*columns))


def member_key_sql(member: str) -> str:
    """Key of a special dimension member."""
    return key_sql(f"'{member}'")


def key_bytes(column: str) -> Column:
    """The 16 bytes of a surrogate key, to move half as much; a text that is no hash is kept as its own bytes."""
    return F.expr(f"coalesce(unhex({column}), encode({column}, 'UTF-8'))").alias(column)
