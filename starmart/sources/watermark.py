"""The stored high-water dates of the incremental loads: an append-only log."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import timestamp_literal
from starmart.params import DEFAULT_WATERMARK
from starmart.sources.schemas import WATERMARK_LOG

WATERMARK_TABLE = "etl_watermark"


def create_watermark_log(spark: SparkSession, root: str) -> None:
    """Create the log if it is not there; an existing log is left alone."""
    try:
        watermark_log(spark, root)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([], WATERMARK_LOG).write.mode("append").parquet(f"{root}/{WATERMARK_TABLE}")


def watermark_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(WATERMARK_LOG).parquet(f"{root}/{WATERMARK_TABLE}")


def current_watermarks(log: DataFrame, targets: DataFrame, default: dt.datetime = DEFAULT_WATERMARK) -> DataFrame:
    """The watermark of every table in ``targets`` (column ``table_name``), the default if it has none."""
    latest = log.groupBy("table_name").agg(F.max("last_loaded_date").alias("last_loaded_date"))
    return targets.join(latest, "table_name", "left").select(
        "table_name", F.coalesce("last_loaded_date", timestamp_literal(default)).alias("last_loaded_date")
    )


def get_watermark(log: DataFrame, table: str, default: dt.datetime = DEFAULT_WATERMARK) -> dt.datetime:
    """The one value an incremental load needs on the driver, as session-zone wall time."""
    latest = log.filter(F.col("table_name") == table).agg(F.max("last_loaded_date").cast("timestamp_ntz"))
    return latest.first()[0] or default


def update_watermark(
    spark: SparkSession, root: str, table: str, value: dt.date | dt.datetime | None, loaded_at: dt.datetime
) -> None:
    """Append the new watermark; earlier ones stay in the log. No value, no row."""
    if value is None:
        return
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    row = spark.range(1, numPartitions=1).select(
        F.lit(table).alias("table_name"),
        timestamp_literal(value).alias("last_loaded_date"),
        timestamp_literal(loaded_at).alias("loaded_at"),
    )
    row.write.mode("append").parquet(f"{root}/{WATERMARK_TABLE}")
