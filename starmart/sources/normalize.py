"""Bringing an extracted batch to its declared types and column names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import timestamp_literal
from starmart.sources import schemas


def normalize_types(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns that are present; a value that does not parse becomes NULL.

    Declared columns that are absent are skipped and undeclared ones kept as they are. All casts sit
    in one projection.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    return batch.select(
        *[
            _parse(batch[_quoted(f.name)], f.dataType, declared[f.name]).alias(f.name)
            if f.name in declared
            else batch[_quoted(f.name)]
            for f in batch.schema.fields
        ]
    )


def normalize_names(batch: DataFrame) -> DataFrame:
    """Column names without outer spaces, lower case, inner spaces and hyphens as underscores."""
    return batch.toDF(*[c.strip().lower().replace(" ", "_").replace("-", "_") for c in batch.columns])


def stamp(batch: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """One ingestion time for the whole batch; it decides which copy of a row is the latest."""
    return batch.withColumn(schemas.INGESTED_AT, timestamp_literal(batch_ts))


def prepare(batch: DataFrame, schema: T.StructType, batch_ts: dt.datetime) -> DataFrame:
    """Types, names, and types again: a column whose name only matches after renaming is parsed then.

    So every stored column has its declared type, and one odd batch cannot make a raw table unreadable.
    """
    return stamp(normalize_types(normalize_names(normalize_types(batch, schema)), schema), batch_ts)


def _lost(batch: DataFrame, schema: T.StructType) -> list[tuple[str, Column, Column]]:
    """(stored name, value, whether it came and did not parse) per declared column that is present under any spelling."""
    declared = {f.name: f.dataType for f in schema.fields}
    found = []
    for name, f in zip(normalize_names(batch).columns, batch.schema.fields):
        if name in declared:
            column = F.col(_quoted(f.name))
            found.append((name, column, column.isNotNull() & _parse(column, f.dataType, declared[name]).isNull()))
    return found


def rejects(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """column_name, arrived, rejected: per declared column the values that came and those that did not parse.

    One pass over the batch; a value that is kept at fewer decimals than it came with is not rejected.
    """
    counts = [
        F.struct(F.lit(name).alias("column_name"), F.count(column).alias("arrived"), F.count_if(lost).alias("rejected"))
        for name, column, lost in _lost(batch, schema)
    ]
    if not counts:
        return batch.sparkSession.createDataFrame([], "column_name string, arrived long, rejected long")
    return batch.agg(F.array(*counts).alias("columns")).select(F.inline("columns"))


def observe_rejects(batch: DataFrame, schema: T.StructType) -> tuple[DataFrame, Callable[[], dict[str, tuple[int, int]]]]:
    """The batch, and what ``rejects`` would count of it, by column: known once a job has read the returned batch."""
    columns = _lost(batch, schema)
    if not columns:
        return batch, dict
    seen = Observation("rejects")
    counts = [c for i, (_, column, lost) in enumerate(columns) for c in (F.count(column).alias(f"a{i}"), F.count_if(lost).alias(f"r{i}"))]
    return batch.observe(seen, *counts), lambda: {
        name: (seen.get[f"a{i}"], seen.get[f"r{i}"]) for i, (name, _, _) in enumerate(columns)
    }


#: Written forms of a day besides ISO, month before day as in the sources.
DAY_FORMS = ("M/d/yyyy", "yyyy/M/d", "yyyyMMdd", "d-MMM-yyyy", "MMM d, yyyy", "d MMM yyyy")


def _parse(column: Column, given: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(wanted, T.StringType):
        return column.cast(wanted)
    if isinstance(wanted, T.DateType) and isinstance(given, T.StringType):
        text = F.trim(column)
        others = [F.try_to_timestamp(text, F.lit(form)).cast("date") for form in DAY_FORMS]
        # a bare number would be read as a year
        iso = F.when(~text.rlike(r"^\d+$"), text.try_cast(wanted))
        return F.coalesce(iso, *others)
    if isinstance(wanted, T.LongType) and not isinstance(given, T.IntegralType):
        # '3.0' and 3.0 are whole numbers, '3.7' is not one and becomes NULL.
        exact = column.try_cast(T.DecimalType(38, 10))
        return F.when(exact == F.floor(exact), exact.try_cast(wanted))
    return column.try_cast(wanted)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
