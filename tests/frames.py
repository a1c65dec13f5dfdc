"""Small hand-made raw tables: rows name only the columns a test is about."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from starmart.params import MartParams
from starmart.plans.mart import Mart
from starmart.sources import schemas
from starmart.sources.registry import DATASETS

RUN_TS = dt.datetime(2024, 6, 15, tzinfo=dt.timezone.utc)
PARAMS = MartParams(as_of=dt.date(2024, 6, 15), run_ts=RUN_TS)
LOADED = dt.datetime(2024, 6, 1)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def sale(order="O1", product="P1", customer="C1", date="2024-01-10", **more) -> dict:
    row = {
        "order_id": order,
        "product_id": product,
        "customer_id": customer,
        "order_date": day(date) if date else None,
        "quantity": 2,
        "price": Decimal("10.00"),
        "unit_cost": Decimal("6.00"),
        "discount": Decimal("0.00"),
        "revenue": Decimal("20.00"),
        "refund_status": "Completed",
        "channel": "Email",
        "campaign_id": "K1",
        "_ingested_at": LOADED,
    }
    return row | more


def ad(ads="A1", date="2024-01-10", **more) -> dict:
    row = {
        "ads_id": ads,
        "date": day(date),
        "campaign_id": "K1",
        "channel_name": "Email",
        "ad_spend": Decimal("5.00"),
        "impressions": 100,
        "clicks": 10,
        "conversions": 2,
        "campaign_objective": "Acquisition",
        "_ingested_at": LOADED,
    }
    return row | more


CUSTOMERS = [{"customer_id": "C1", "region": "North", "age": 30}, {"customer_id": "C2", "region": "South", "age": 60}]
PRODUCTS = [{"product_id": "P1", "price": Decimal("10.00"), "unit_cost": Decimal("6.00"), "category": "Tea"}]
CHANNELS = [{"channel_name": "Email", "channel_category": "Paid"}, {"channel_name": "Web", "channel_category": "Paid"}]
CAMPAIGNS = [{"campaign_id": "K1", "channel": "Email", "campaign_name": "One", "campaign_type": "Acquisition"}]


def raw(spark: SparkSession, **rows: list[dict]) -> dict[str, DataFrame]:
    """Raw tables by name; a dataset that is not given gets the default rows above."""
    given = {
        "customers": CUSTOMERS,
        "products": PRODUCTS,
        "channels": CHANNELS,
        "campaigns": CAMPAIGNS,
        "sales": [],
        "marketing": [],
    } | rows
    tables = {}
    for name, records in given.items():
        schema = schemas.stored(DATASETS[name].schema)
        values = [tuple(r.get(f.name) for f in schema.fields) for r in records]
        tables[f"raw_{name}"] = spark.createDataFrame(values, schema)
    return tables


def mart(spark: SparkSession, params: MartParams = PARAMS, **rows: list[dict]) -> Mart:
    return Mart(spark, raw(spark, **rows), params)


def dicts(frame: DataFrame) -> list[dict]:
    return [r.asDict() for r in frame.collect()]
