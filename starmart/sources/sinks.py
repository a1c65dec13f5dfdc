"""Writing batches and mart tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.functions import month_of
from starmart.sources.registry import FULL, INCREMENTAL

LOAD_TYPES = (FULL, INCREMENTAL)
BATCH_LIST = "batches"


def write_batch(
    batch: DataFrame,
    root: str,
    table: str,
    load_type: str,
    watermark_column: str | None = None,
    accept: Callable[[], None] = lambda: None,
) -> dt.date | dt.datetime | None:
    """Write one prepared batch and return the largest watermark value in it.

    The batch is read once, by the one job that writes it into a folder of its own; its row count and its
    largest watermark are observed on the way. Then one line in the table's list of batches makes it part of
    the table, or, after a full load, the whole of it. A load that fails, or is empty, adds no line and
    leaves the table as it was. So does one that ``accept`` refuses by raising: it is called when the rows are written.
    """
    if load_type not in LOAD_TYPES:
        raise ValueError(f"unknown load type {load_type!r} for {table}, expected one of {list(LOAD_TYPES)}")
    seen = Observation(f"load of {table}")
    reached = F.max(watermark_column) if watermark_column is not None else F.lit(None)
    observed = batch.observe(seen, F.count(F.lit(1)).alias("row_count"), reached.alias("watermark"))
    name = f"batch-{uuid.uuid4().hex}"
    observed.write.mode("error").parquet(f"{root}/{table}/{name}")
    if not seen.get["row_count"]:
        return None
    accept()
    line = batch.sparkSession.range(1, numPartitions=1).select(
        F.lit(name).alias("batch"), F.lit(load_type == FULL).alias("replaces"), F.current_timestamp().alias("listed_at")
    )
    line.write.mode("append").parquet(f"{root}/{table}/{BATCH_LIST}")
    return seen.get["watermark"] if watermark_column is not None else None


def batches(spark: SparkSession, root: str, table: str) -> list[str]:
    """The folders whose rows make up the table now: the last full load and what was appended since."""
    schema = "batch string, replaces boolean, listed_at timestamp"
    listed = spark.read.schema(schema).parquet(f"{root}/{table}/{BATCH_LIST}")
    start = F.max(F.when(F.col("replaces"), F.col("listed_at")))
    start = listed.agg(F.coalesce(start, F.min("listed_at")).alias("start")).scalar()
    return [f"{root}/{table}/{r['batch']}" for r in listed.filter(F.col("listed_at") >= start).orderBy("listed_at").collect()]


def write_table(table: DataFrame, path: str) -> int:
    """A rebuilt mart table of moderate size; its rows are counted while they are written."""
    seen = Observation(f"write of {path}")
    table.observe(seen, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite").parquet(path)
    return seen.get["row_count"]


def write_fact(fact: DataFrame, path: str, date_column: str = "date_key") -> None:
    """A rebuilt fact, its rows gathered by month and sorted by date within each file.

    Files and their row groups then hold narrow ranges of dates, so that a filter on the date itself skips
    the others. The rebalance splits a month that holds a large share of the rows over several tasks.
    """
    month = f"{date_column}_month"
    gathered = fact.withColumn(month, month_of(date_column)).hint("rebalance", month).drop(month)
    gathered.sortWithinPartitions(date_column).write.mode("overwrite").parquet(path)
