"""The expected results as plain SQL over the supplied tables, for DuckDB."""

from oracle.queries import oracle_sql

__all__ = ["oracle_sql"]
