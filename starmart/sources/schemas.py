"""Declared columns of the raw tables and the watermark log."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.LongType()
#: Amounts keep nine decimals from ingest to fact; products and sums are computed at the same scale.
MONEY = T.DecimalType(38, 9)
DISCOUNT = T.DecimalType(10, 9)
DAY = T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CUSTOMERS = _schema(
    customer_id=TEXT,
    gender=TEXT,
    age=WHOLE,
    country=TEXT,
    region=TEXT,
    city=TEXT,
    acquisition_date=DAY,
    acquisition_channel=TEXT,
    acquisition_campaign=TEXT,
)
PRODUCTS = _schema(
    product_id=TEXT,
    product_name=TEXT,
    price=MONEY,
    sub_category=TEXT,
    category=TEXT,
    brand=TEXT,
    supplier_id=TEXT,
    unit_cost=MONEY,
)
CAMPAIGNS = _schema(
    campaign_id=TEXT,
    campaign_type=TEXT,
    channel=TEXT,
    start_date=DAY,
    end_date=DAY,
    total_revenue=MONEY,
    campaign_name=TEXT,
    budget=MONEY,
    campaign_objective=TEXT,
)
CHANNELS = _schema(channel_name=TEXT, channel_category=TEXT, traffic_type=TEXT)
SALES = _schema(
    order_id=TEXT,
    customer_id=TEXT,
    customer_status=TEXT,
    product_id=TEXT,
    product_name=TEXT,
    category=TEXT,
    ship_mode=TEXT,
    quantity=WHOLE,
    discount=DISCOUNT,
    unit_cost=MONEY,
    price=MONEY,
    refund_status=TEXT,
    revenue=MONEY,
    order_date=DAY,
    channel=TEXT,
    campaign_id=TEXT,
)
MARKETING = _schema(
    ads_id=TEXT,
    campaign_id=TEXT,
    channel_name=TEXT,
    date=DAY,
    ad_spend=MONEY,
    impressions=WHOLE,
    clicks=WHOLE,
    conversions=WHOLE,
    campaign_type=TEXT,
    campaign_objective=TEXT,
)

INGESTED_AT = "_ingested_at"

WATERMARK_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("last_loaded_date", T.TimestampType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
    ]
)


def stored(schema: T.StructType) -> T.StructType:
    """Schema of the raw table: the declared columns and the ingestion stamp."""
    return T.StructType([*schema.fields, T.StructField(INGESTED_AT, T.TimestampType())])
