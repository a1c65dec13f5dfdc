"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_sql(column: str) -> str:
    """Text without white space at either end (tabs and line breaks too, unlike plain ``trim``).

    Most values start and end with a printable ASCII character and pass unchanged; only the others
    are searched for the longer list.
    """
    text = f"cast({column} as string)"
    return (
        f"CASE WHEN ascii({text}) BETWEEN 33 AND 126 AND ascii(substring({text}, -1, 1)) BETWEEN 33 AND 126 "
        f"THEN {text} ELSE trim(BOTH '{WHITESPACE}' FROM {text}) END"
    )


def clean(column: str) -> Column:
    return F.expr(clean_sql(column)).alias(column)


def clean_lower(column: str) -> Column:
    return F.expr(f"lower({clean_sql(column)})").alias(column)
