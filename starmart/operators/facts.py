"""The sales and marketing facts.

Each row keeps its grain through left joins on the natural keys: rows without a match keep their own
id until after the join, so they stay spread over the tasks and only then share a member key. Large
dimensions are joined first, while the rows are narrow: customers and products are only looked up by their ids, and the
key, a hash of the id that rows have anyway, is made after the last join, so that it is not moved.

Where the ids that the sales use are at hand, ``exceptions`` lists those that a dimension does not have exactly once. They are
few, so that Spark broadcasts them and the lines are not moved at all; if they are many, the join is shuffled as with the whole dimension.
"""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import key_sql, member_key_sql, ratio, surrogate_key, unit_margin_sql
from starmart.functions.audit import with_loaded_at
from starmart.operators.calendar import resolved_date_sql
from starmart.params import UNATTRIBUTED, UNKNOWN, MartParams


#: Products of amounts. Precision 28 leaves room for nine decimals in a further product with a discount; an amount or
#: a quantity too large for it is an error under Spark's default ANSI mode, not a NULL.
PRODUCT = "decimal(28,9)"


def _times(count: str, amount: str) -> str:
    return f"cast(cast({count} as decimal(10,0)) * cast({amount} as decimal(20,9)) as {PRODUCT})"


def fact_sales(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    channels: DataFrame,
    campaigns: DataFrame,
    params: MartParams,
    odd: Mapping[str, DataFrame] = MappingProxyType({}),
) -> DataFrame:
    """One row per order line, with the keys of the five dimensions.

    ``odd`` gives, by id column, the ``exceptions`` of a dimension; they then stand in for it.
    """
    found = _found(_found(sales, customers, "customer_id", odd), products, "product_id", odd)
    found = found.join(channels.select(F.col("channel_name").alias("channel"), "channel_key"), "channel", "left")
    rows = (
        _found(found, campaigns, "campaign_id", odd)
        .withColumn("campaign_key", F.expr(f"CASE WHEN _campaign_id IS NOT NULL THEN {key_sql('_campaign_id')} END"))
        .select(
            surrogate_key("order_id", "product_id").alias("sales_key"),
            "order_id",
            F.expr(resolved_date_sql("order_date", params)).alias("date_key"),
            _hashed_or_unknown("customer_key", "_customer_id"),
            _hashed_or_unknown("product_key", "_product_id"),
            _attributed("channel_key", "channel"),
            _attributed("campaign_key", "campaign_id"),
            "ship_mode",
            "refund_status",
            F.col("customer_status").alias("source_customer_status"),
            "quantity",
            "price",
            "unit_cost",
            "discount",
            F.col("revenue").alias("net_sales"),
            F.expr(_times("quantity", "price")).alias("gross_sales"),
            F.expr(_times("quantity", "unit_cost")).alias("total_cost"),
            F.expr(f"cast({_times('quantity', 'price')} * discount as {PRODUCT})").alias("discount_amount"),
            F.expr(f"cast(cast(revenue as {PRODUCT}) - {_times('quantity', 'unit_cost')} as {PRODUCT})").alias("gross_profit"),
            F.expr(unit_margin_sql()).alias("unit_margin"),
            F.expr("refund_status = 'refunded'").alias("is_refunded"),
        )
    )
    return with_loaded_at(rows, params)


def fact_marketing(marketing: DataFrame, channels: DataFrame, campaigns: DataFrame, params: MartParams) -> DataFrame:
    """One row per ad record. Spend always belongs somewhere, so a missing key is unknown, never unattributed."""
    rows = (
        marketing.join(campaigns.select("campaign_id", "campaign_key"), "campaign_id", "left")
        .join(channels.select("channel_name", "channel_key"), "channel_name", "left")
        .select(
            surrogate_key("ads_id").alias("marketing_key"),
            F.expr(resolved_date_sql("date", params)).alias("date_key"),
            _or_unknown("campaign_key"),
            _or_unknown("channel_key"),
            "ads_id",
            "ad_spend",
            "impressions",
            "clicks",
            "conversions",
            "campaign_objective",
            ratio("clicks", "impressions").alias("click_through_rate"),
            ratio("conversions", "clicks").alias("conversion_rate"),
            ratio("ad_spend", "clicks").alias("cost_per_click"),
            (ratio("ad_spend", "impressions") * 1000).alias("cost_per_thousand_impressions"),
            ratio("ad_spend", "conversions").alias("cost_per_conversion"),
        )
    )
    return with_loaded_at(rows, params)


def exceptions(ids: DataFrame, members: DataFrame, column: str) -> DataFrame:
    """(id, found): the ``ids`` that are not in ``members`` exactly once; an id that is there n times stands n times.

    ``ids`` may repeat, and hold more ids than the fact's lines.
    """
    copies = members.groupBy(F.col(column).alias("_member")).agg(F.count("*").alias("copies"))
    used = ids.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    odd = used.join(copies, F.expr("id = _member"), "left").filter("copies IS NULL OR copies > 1")
    return odd.selectExpr("id", "explode(array_repeat(copies IS NOT NULL, int(coalesce(copies, 1)))) AS found")


def _found(rows: DataFrame, members: DataFrame, column: str, odd: Mapping[str, DataFrame]) -> DataFrame:
    """Each row as often as ``members`` has its id, once if not at all: the id again as ``_<column>``, NULL if not there."""
    if column not in odd:
        return rows.join(members.select(F.col(column).alias(f"_{column}")), F.expr(f"{column} = _{column}"), "left")
    few = odd[column].select(F.col("id").alias("_odd"), "found")
    joined = rows.join(few, F.expr(f"{column} = _odd"), "left")
    return joined.withColumn(f"_{column}", F.expr(f"CASE WHEN coalesce(found, true) THEN {column} END")).drop("_odd", "found")


def _hashed_or_unknown(key: str, found: str) -> Column:
    """The member's surrogate key from the id it was found by."""
    return F.expr(f"CASE WHEN {found} IS NULL THEN {member_key_sql(UNKNOWN)} ELSE {key_sql(found)} END").alias(key)


def _or_unknown(key: str) -> Column:
    return F.expr(f"coalesce({key}, {member_key_sql(UNKNOWN)})").alias(key)


def _attributed(key: str, natural: str) -> Column:
    """A row that names nothing is unattributed, one whose name has no match is unknown."""
    return F.expr(
        f"CASE WHEN {natural} IS NULL OR {natural} = '' THEN {member_key_sql(UNATTRIBUTED)} "
        f"ELSE coalesce({key}, {member_key_sql(UNKNOWN)}) END"
    ).alias(key)
