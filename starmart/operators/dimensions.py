"""Channel, campaign, customer and product dimensions, each with its special members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import clean_lower, member_key_sql, surrogate_key, unit_margin_sql
from starmart.functions.audit import with_loaded_at
from starmart.params import UNATTRIBUTED, UNKNOWN, MartParams

# The age bands (a missing age falls in the last one) and the customer statuses.
AGE_BAND = """
CASE
    WHEN age < 18 THEN 'Under 18'
    WHEN age <= 24 THEN '18-24'
    WHEN age <= 34 THEN '25-34'
    WHEN age <= 44 THEN '35-44'
    WHEN age <= 54 THEN '45-54'
    ELSE '55+'
END
"""
CUSTOMER_STATUS = "CASE WHEN lifetime_orders IS NULL THEN 'prospect' WHEN lifetime_orders = 1 THEN 'new' ELSE 'returning' END"


def dim_channels(channels: DataFrame) -> DataFrame:
    rows = channels.select(
        surrogate_key("channel_name").alias("channel_key"), "channel_name", "channel_category", "traffic_type"
    )
    return with_members(rows, "channel_key", UNATTRIBUTED, UNKNOWN)


def dim_campaigns(campaigns: DataFrame, channels: DataFrame, params: MartParams) -> DataFrame:
    """``channels`` is the channel dimension; a campaign whose channel is not in it has no channel key."""
    lookup = channels.select("channel_key", F.col("channel_name").alias("channel"))
    rows = campaigns.join(lookup, "channel", "left").select(
        surrogate_key("campaign_id").alias("campaign_key"),
        "campaign_id",
        "channel_key",
        "campaign_name",
        "campaign_type",
        "campaign_objective",
        "start_date",
        "end_date",
        "budget",
    )
    members = with_members(rows, "campaign_key", UNATTRIBUTED, UNKNOWN, hashed=("channel_key",))
    return with_loaded_at(members, params)


def dim_products(products: DataFrame) -> DataFrame:
    rows = products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "product_name",
        "price",
        "unit_cost",
        "sub_category",
        "category",
        "brand",
        "supplier_id",
        F.expr(unit_margin_sql()).alias("unit_margin"),
    )
    return with_members(rows, "product_key", UNKNOWN, empty=("supplier_id",))


def customer_orders(sales: DataFrame) -> DataFrame:
    """Purchase history per customer. Refunded orders count as orders but bring no revenue.

    The one distinct count is planned in two steps, first per customer and order, so the orders of a
    very large customer are spread over many tasks.
    """
    return sales.groupBy("customer_id").agg(
        F.min("order_date").alias("first_purchase_date"),
        F.max("order_date").alias("latest_purchase_date"),
        F.count_distinct("order_id").alias("lifetime_orders"),
        F.sum(F.when(F.col("refund_status") != "refunded", F.col("revenue")))
        .cast("decimal(38,9)")
        .alias("lifetime_revenue"),
    )


def dim_customers(customers: DataFrame, sales: DataFrame, params: MartParams) -> DataFrame:
    return customers_with_history(customers, customer_orders(sales), params)


def customers_with_history(customers: DataFrame, history: DataFrame, params: MartParams) -> DataFrame:
    """``history`` has the columns of ``customer_orders``."""
    rows = customers.join(history, "customer_id", "left").select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "gender",
        "age",
        F.expr(AGE_BAND).alias("age_band"),
        "country",
        "region",
        "city",
        "acquisition_date",
        "acquisition_channel",
        clean_lower("acquisition_campaign"),
        "first_purchase_date",
        "latest_purchase_date",
        "lifetime_orders",
        "lifetime_revenue",
        F.expr(CUSTOMER_STATUS).alias("customer_status"),
    )
    return with_loaded_at(with_members(rows, "customer_key", UNKNOWN, empty=("gender", "age")), params)


def with_members(
    rows: DataFrame, key: str, *members: str, empty: tuple[str, ...] = (), hashed: tuple[str, ...] = ()
) -> DataFrame:
    """``rows`` and one row per special member.

    A member's key is the hash of its name (so are the ``hashed`` columns), its texts are its name,
    its amounts and counts are zero; dates and the ``empty`` columns are NULL. The member rows are
    literals, so they add no scan.
    """

    session = rows.sparkSession
    for member in members:
        literals = []
        for name, kind in rows.dtypes:
            if name == key or name in hashed:
                value = member_key_sql(member)
            elif name in empty or kind == "date":
                value = "NULL"
            else:
                value = f"'{member}'" if kind == "string" else "0"
            literals.append(f"cast({value} as {kind}) AS {name}")
        rows = rows.unionByName(session.range(0, 1, 1, 1).selectExpr(*literals))
    return rows
