"""The audit column of the built tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.dates import timestamp_literal
from starmart.params import MartParams


def with_loaded_at(table: DataFrame, params: MartParams) -> DataFrame:
    stamp = timestamp_literal(params.run_ts) if params.run_ts else F.current_timestamp()
    return table.withColumn("loaded_at", stamp)
