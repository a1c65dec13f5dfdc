"""Staging: trimmed and typed rows, one per natural key for the two append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import clean, clean_lower
from starmart.sources.schemas import DISCOUNT, INGESTED_AT, MONEY

# The natural keys, and what decides between copies of a key.
SALES_KEY, SALES_ORDER = ["order_id", "product_id"], [INGESTED_AT, "price", "quantity", "discount"]
SPREAD = "_spread"
BUCKET = ("order_id", SPREAD)
ADS_KEY, ADS_ORDER = ["ads_id"], [INGESTED_AT, "ad_spend"]


def stg_campaigns(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean("campaign_id"),
        clean_lower("campaign_type"),
        clean_lower("campaign_objective"),
        clean_lower("channel"),
        _date("start_date"),
        _date("end_date"),
        _money("total_revenue"),
        clean_lower("campaign_name"),
        _money("budget"),
    )


def stg_channels(raw: DataFrame) -> DataFrame:
    return raw.select(clean_lower("channel_name"), clean_lower("channel_category"), clean_lower("traffic_type"))


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean("customer_id"),
        clean_lower("gender"),
        _whole("age"),
        clean_lower("country"),
        clean_lower("region"),
        clean_lower("city"),
        _date("acquisition_date"),
        clean_lower("acquisition_channel"),
        clean("acquisition_campaign"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean("product_id"),
        clean_lower("product_name"),
        _money("price"),
        clean_lower("sub_category"),
        clean_lower("category"),
        clean_lower("brand"),
        clean("supplier_id"),
        _money("unit_cost"),
    )


def stg_sales(raw: DataFrame) -> DataFrame:
    return latest_copy(typed_sales(raw), SALES_KEY, SALES_ORDER)


def keyed_by_order(typed: DataFrame) -> DataFrame:
    """Typed sales with a column that spreads the lines without an order id: buckets by it and the order id hold whole keys."""
    return typed.withColumn(SPREAD, F.expr("CASE WHEN coalesce(order_id, '') = '' THEN product_id END"))


def stg_keyed_sales(keyed: DataFrame) -> DataFrame:
    """``stg_sales`` of rows that ``keyed_by_order`` gave."""
    return latest_copy(keyed, [*SALES_KEY, SPREAD], SALES_ORDER).drop(SPREAD)


def typed_sales(raw: DataFrame) -> DataFrame:
    """Every copy of every line, trimmed and typed, with its ingestion stamp."""
    return raw.select(
        clean("order_id"),
        clean("customer_id"),
        clean_lower("customer_status"),
        clean("product_id"),
        clean_lower("product_name"),
        clean_lower("category"),
        clean_lower("ship_mode"),
        _whole("quantity"),
        _discount("discount"),
        _money("unit_cost"),
        _money("price"),
        _money("revenue"),
        clean_lower("refund_status"),
        _date("order_date"),
        clean_lower("channel"),
        clean("campaign_id"),
        INGESTED_AT,
    )


def stg_marketing(raw: DataFrame) -> DataFrame:
    return latest_copy(typed_marketing(raw), ADS_KEY, ADS_ORDER)


def typed_marketing(raw: DataFrame) -> DataFrame:
    """Every copy of every ad record, trimmed and typed, with its ingestion stamp."""
    return raw.select(
        clean("ads_id"),
        clean("campaign_id"),
        clean_lower("channel_name"),
        clean_lower("campaign_objective"),
        _date("date"),
        _money("ad_spend"),
        _whole("impressions"),
        _whole("clicks"),
        _whole("conversions"),
        clean_lower("campaign_type"),
        INGESTED_AT,
    )


def latest_copy(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row by ``order`` for each key, the ingestion stamp dropped."""
    return latest_stamped(rows, keys, order).drop(INGESTED_AT)


def latest_stamped(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row by ``order`` for each key.

    The remaining columns follow in the order, so ties do not depend on how the rows are spread.
    The rank filter is planned as a group limit before the shuffle: each task sends at most one copy
    per key, however many copies a key has. NULL key parts form keys like any other value.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    latest = ", ".join(f"`{c}` DESC NULLS LAST" for c in [*order, *rest])
    window = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {latest})"
    return rows.withColumn("copy_rank", F.expr(window)).filter("copy_rank = 1").drop("copy_rank")


def _date(name: str) -> Column:
    return F.col(name).try_cast("date").alias(name)


def _money(name: str) -> Column:
    return F.col(name).try_cast(MONEY).alias(name)


def _discount(name: str) -> Column:
    return F.col(name).try_cast(DISCOUNT).alias(name)


def _whole(name: str) -> Column:
    return F.col(name).try_cast("bigint").alias(name)
