"""Ratio measures: sums first, the ratio last, at the grouping asked for."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import key_bytes, month_of, ratio
from starmart.operators.aggregates import customers_and_orders, kept


@dataclass(frozen=True)
class Measure:
    """The sum of ``total``, over the sum of ``per`` where there is one, on the ``tables`` it may be read from.

    Distinct counts of a finer table, and spend that repeats on every region's row, must not be summed: a table on
    which a measure would be wrong is not in its list.
    """

    name: str
    tables: tuple[str, ...]
    total: str
    per: str | None = None


MONTHLY_OR_SEGMENT = ("monthly_customers", "agg_customer_segment")
NEW_CUSTOMERS = ("monthly_customers", "acquisition_results")
SPEND = ("acquisition_results", "campaign_results", "agg_channel_funnel_daily")
CAMPAIGN_REVENUE = ("campaign_results", "agg_campaign_performance")

MEASURES = {
    measure.name: measure
    for measure in (
        # daily growth
        Measure("revenue", ("agg_growth_daily",), "total_revenue"),
        Measure("orders", ("agg_growth_daily",), "total_orders"),
        Measure("average_order_value", ("agg_growth_daily",), "total_revenue", "total_orders"),
        Measure("gross_profit", ("agg_growth_daily",), "gross_profit"),
        Measure("gross_margin", ("agg_growth_daily",), "gross_profit", "total_revenue"),
        # unit economics
        Measure("units", ("monthly_sales",), "total_units"),
        Measure("average_selling_price", ("monthly_sales",), "total_revenue", "total_units"),
        Measure("revenue_per_customer", ("monthly_sales",), "total_revenue", "total_customers"),
        Measure("orders_per_customer", ("monthly_sales",), "total_orders", "total_customers"),
        # discounts
        Measure("discount_rate", ("discounts",), "discount_amount", "gross_sales"),
        Measure("discount_frequency", ("discounts",), "discounted_lines", "lines"),
        # customers
        Measure("customers", MONTHLY_OR_SEGMENT, "total_customers"),
        Measure("new_customer_count", NEW_CUSTOMERS, "new_customers"),
        Measure("returning_customer_count", ("monthly_customers",), "returning_customers"),
        Measure("repeat_purchase_rate", ("monthly_customers",), "returning_customers", "total_customers"),
        Measure("same_month_repeat_rate", ("agg_customer_segment",), "customers_with_multiple_orders_in_month", "total_customers"),
        Measure("average_customer_revenue", ("agg_customer_segment",), "total_revenue", "total_customers"),
        Measure("purchase_frequency", ("agg_customer_segment",), "total_orders", "total_customers"),
        # cohorts
        Measure("cohort_customers", ("agg_customer_cohort",), "cohort_size"),
        Measure("active_cohort_customers", ("agg_customer_cohort",), "active_customers"),
        Measure("retention", ("agg_customer_cohort",), "active_customers", "cohort_size"),
        # campaigns and channels
        Measure("ad_spend", SPEND, "total_ad_spend"),
        Measure("acquisition_spend", ("acquisition_results",), "acquisition_cost"),
        Measure("customer_acquisition_cost", ("acquisition_results",), "acquisition_cost", "new_customers"),
        Measure("campaign_revenue", CAMPAIGN_REVENUE, "total_revenue"),
        Measure("return_on_ad_spend", ("campaign_results",), "total_revenue", "total_ad_spend"),
        Measure("profit_on_ad_spend", ("campaign_results",), "gross_profit", "total_ad_spend"),
        Measure("impression_count", ("agg_channel_funnel_daily",), "total_impressions"),
        Measure("click_count", ("agg_channel_funnel_daily",), "total_clicks"),
        Measure("conversion_count", ("agg_channel_funnel_daily",), "total_conversions"),
        Measure("click_through_rate", ("agg_channel_funnel_daily",), "total_clicks", "total_impressions"),
        Measure("conversion_rate", ("agg_channel_funnel_daily",), "total_conversions", "total_clicks"),
        Measure("cost_per_conversion", ("agg_channel_funnel_daily",), "total_ad_spend", "total_conversions"),
    )
}


def measure(rows: DataFrame, *names: str, table: str, by: Iterable[str] = (), where: Column | None = None) -> DataFrame:
    """The named measures of ``rows`` per ``by``, in one aggregation; a zero denominator gives NULL.

    ``table`` says which table, or which function of this module, ``rows`` comes from; a measure that would be wrong
    on it is an error.
    """
    by = list(by)
    wanted = [MEASURES[name] for name in names]
    for m in wanted:
        if table not in m.tables:
            raise ValueError(f"{m.name} cannot be read from {table}, only from {', '.join(m.tables)}")
    sums = dict.fromkeys(c for m in wanted for c in (m.total, m.per) if c)
    chosen = rows if where is None else rows.filter(where)
    # Sums get names of their own: a measure may be called like the column it sums.
    totals = chosen.groupBy(*by).agg(*[F.sum(c).alias(f"sum of {c}") for c in sums])
    return totals.select(
        *by,
        *[
            (ratio(f"`sum of {m.total}`", f"`sum of {m.per}`") if m.per else F.col(f"sum of {m.total}")).alias(m.name)
            for m in wanted
        ],
    )


def share(rows: DataFrame, column: str, by: Iterable[str], within: Iterable[str], name: str) -> DataFrame:
    """The part of each ``by`` group in the total of its ``within`` group.

    The window runs over the summed groups, not over the rows.
    """
    by, within = list(by), list(within)
    totals = rows.groupBy(*by).agg(F.sum(column).alias(f"sum of {column}"))
    context = f"sum(`sum of {column}`) OVER (PARTITION BY {', '.join(within)})"
    return totals.withColumn(name, ratio(f"`sum of {column}`", context)).drop(f"sum of {column}")


def monthly_customers(sales: DataFrame, customers: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Customers per month, exactly: all, with their first purchase in the month, and with an earlier one.

    From the fact, since distinct counts of a finer table cannot be added up. Lines are reduced to
    customer-months before the join. ``by`` names customer attributes.
    """
    by = list(by)
    active = sales.select(month_of("date_key").alias("report_month"), key_bytes("customer_key")).distinct()
    first = customers.select(key_bytes("customer_key"), month_of("first_purchase_date").alias("first_month"), *by)
    month, first_month = F.col("report_month"), F.col("first_month")
    return (
        active.join(first, "customer_key")
        .groupBy("report_month", *by)
        .agg(
            F.count("*").alias("total_customers"),
            F.count_if(first_month == month).alias("new_customers"),
            F.count_if(first_month < month).alias("returning_customers"),
        )
    )


def monthly_sales(sales: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Distinct customers and orders, units and money per month, refunds left out of units and money."""
    keys = ["report_month", *by]
    rows = sales.select(
        month_of("date_key").alias("report_month"),
        *by,
        "customer_key",
        "order_id",
        kept("net_sales").alias("revenue"),
        kept("gross_profit").alias("gross_profit"),
        kept("quantity").alias("units"),
    )
    return customers_and_orders(rows, keys, sums=("units",)).withColumnRenamed("units", "total_units")


def discounts(sales: DataFrame) -> DataFrame:
    """Discount and list value per month and product, with the counts of all and of discounted lines."""
    return sales.groupBy(month_of("date_key").alias("report_month"), "product_key").agg(
        F.sum("discount_amount").alias("discount_amount"),
        F.sum("gross_sales").alias("gross_sales"),
        F.count_if(F.col("discount") > 0).alias("discounted_lines"),
        F.count("*").alias("lines"),
    )


def campaign_results(sales: DataFrame, marketing: DataFrame) -> DataFrame:
    """Month x campaign x channel with sales and spend side by side, spend counted once.

    The spend columns of the daily and campaign tables repeat over regions; this has no region.
    """
    keys = ["report_month", "campaign_key", "channel_key"]
    month = month_of("date_key").alias("report_month")
    sold = sales.groupBy(month, *keys[1:]).agg(
        _money_sum(kept("net_sales")).alias("total_revenue"), _money_sum(kept("gross_profit")).alias("gross_profit")
    )
    return sold.join(spend(marketing, keys), keys, "full_outer")


def spend(marketing: DataFrame, keys: list[str]) -> DataFrame:
    acquisition = F.when(F.col("campaign_objective") == "acquisition", F.col("ad_spend"))
    rows = marketing.withColumn("report_month", month_of("date_key"))
    return rows.groupBy(*keys).agg(
        _money_sum(F.col("ad_spend")).alias("total_ad_spend"),
        F.coalesce(_money_sum(acquisition), F.lit(0)).alias("acquisition_cost"),
    )


def acquisition_results(sales: DataFrame, marketing: DataFrame, customers: DataFrame) -> DataFrame:
    """Month with acquisition spend and the customers whose first purchase was in it."""
    new = monthly_customers(sales, customers)
    return new.join(spend(marketing, ["report_month"]), "report_month", "full_outer")


def average_lifetime_revenue(customers: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Mean lifetime revenue of the customers that bought something not refunded, over their whole history."""
    return customers.groupBy(*by).agg(
        ratio("sum(lifetime_revenue)", "count(lifetime_revenue)").alias("average_lifetime_revenue")
    )


def _money_sum(column: Column) -> Column:
    return F.sum(column).cast("decimal(38,9)")
