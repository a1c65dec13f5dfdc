"""The six datasets: where each comes from, where it goes and how it is loaded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from starmart.sources import schemas

FULL = "full"
INCREMENTAL = "incremental"


@dataclass(frozen=True)
class Dataset:
    name: str
    source: str
    target: str
    load_type: str
    schema: StructType
    watermark_column: str | None = None


# Source tables, raw tables, load types and watermark columns.
DATASETS = {
    dataset.name: dataset
    for dataset in (
        Dataset("customers", "dim_customers", "raw_customers", FULL, schemas.CUSTOMERS, "acquisition_date"),
        Dataset("sales", "fact_sales", "raw_sales", INCREMENTAL, schemas.SALES, "order_date"),
        Dataset("products", "dim_products", "raw_products", FULL, schemas.PRODUCTS),
        Dataset("campaigns", "dim_campaign", "raw_campaigns", FULL, schemas.CAMPAIGNS),
        Dataset("channels", "dim_channel", "raw_channels", FULL, schemas.CHANNELS),
        Dataset("marketing", "fact_marketing", "raw_marketing", INCREMENTAL, schemas.MARKETING, "date"),
    )
}
