"""The reporting aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import key_bytes, month_of, months_apart, percent_half_up
from starmart.functions.audit import with_loaded_at
from starmart.params import UNKNOWN, MartParams

COHORT_MONTHS = 12


def agg_growth_daily(
    sales: DataFrame,
    marketing: DataFrame,
    customers: DataFrame,
    channels: DataFrame,
    campaigns: DataFrame,
    params: MartParams,
) -> DataFrame:
    """Day x channel x campaign x region.

    Spend has no region: the day's spend of a channel and campaign stands on the row of every region
    that sold there, so it must not be summed over regions.
    """
    day = F.col("date_key")
    keys = ["report_date", "channel_key", "campaign_key"]
    sold = _sales_by_region(sales, customers, "report_date", day, F.col("first_purchase_date"))
    spent = marketing.groupBy(day.alias("report_date"), "channel_key", "campaign_key").agg(*_spend())
    rows = _with_names(sold.join(spent, keys, "full_outer"), channels, campaigns)
    table = rows.select(
        "report_date",
        "channel_name",
        "campaign_id",
        "campaign_name",
        "campaign_type",
        F.coalesce("region", F.lit(UNKNOWN)).alias("region"),
        *_zero_filled(
            "total_customers", "new_customers", "returning_customers", "total_orders", "total_revenue",
            "gross_profit", "acquisition_cost", "total_ad_spend",
        ),
    )
    return with_loaded_at(table, params)


def agg_campaign_performance(
    sales: DataFrame,
    marketing: DataFrame,
    customers: DataFrame,
    channels: DataFrame,
    campaigns: DataFrame,
    params: MartParams,
) -> DataFrame:
    """Month x campaign x channel x region; spend repeats over regions as in the daily table."""
    month = month_of("date_key")
    keys = ["report_month", "channel_key", "campaign_key"]
    sold = _sales_by_region(sales, customers, "report_month", month, month_of("first_purchase_date"))
    spent = marketing.groupBy(month.alias("report_month"), "channel_key", "campaign_key").agg(
        *_spend(), *_funnel()
    )
    rows = _with_names(sold.join(spent, keys, "full_outer"), channels, campaigns)
    table = rows.select(
        "report_month",
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "channel_name",
        F.coalesce("region", F.lit(UNKNOWN)).alias("region"),
        *_zero_filled(
            "total_orders", "total_customers", "new_customers", "total_revenue", "gross_profit",
            "total_ad_spend", "acquisition_cost", "impressions", "clicks", "conversions",
        ),
    )
    return with_loaded_at(table, params)


def agg_channel_performance(
    sales: DataFrame, marketing: DataFrame, channels: DataFrame, params: MartParams
) -> DataFrame:
    """Month x channel, for channels that sold. Refunded sales are part of revenue here."""
    month = month_of("date_key").alias("report_month")
    keys = ["report_month", "channel_key"]
    sold = customers_and_orders(
        sales.select(
            month, "channel_key", "customer_key", "order_id", F.col("net_sales").alias("revenue"), "gross_profit"
        ),
        keys,
    )
    spent = marketing.groupBy(month, "channel_key").agg(_spend()[0], *_funnel())
    rows = sold.join(spent, keys, "left").join(channels.select("channel_key", "channel_name"), "channel_key")
    table = rows.select(
        "report_month",
        "channel_name",
        "total_orders",
        "total_customers",
        "total_revenue",
        "gross_profit",
        *_zero_filled("total_ad_spend", "impressions", "clicks", "conversions"),
    )
    return with_loaded_at(table, params)


def agg_channel_funnel_daily(marketing: DataFrame, channels: DataFrame, params: MartParams) -> DataFrame:
    """Day x channel. Ads are summed per key first, so the join sees a few rows per day."""
    attributes = ["channel_name", "channel_category", "traffic_type"]
    per_key = marketing.groupBy("date_key", "channel_key").agg(_spend()[0], *_funnel())
    table = (
        per_key.join(channels, "channel_key")
        .groupBy("date_key", *attributes)
        .agg(
            _money_sum("total_ad_spend").alias("total_ad_spend"),
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("conversions").alias("total_conversions"),
        )
    )
    return with_loaded_at(table, params)


def agg_customer_segment(sales: DataFrame, customers: DataFrame, params: MartParams) -> DataFrame:
    """Month x region x gender x age band x status.

    Lines are summed per customer and month before the join with the customers: the join moves
    customer-months instead of order lines, and no customer has more of those than there are months.
    """
    attributes = ["region", "gender", "age_band", "customer_status"]
    lines = sales.withColumns({"report_month": month_of("date_key"), "customer_key": key_bytes("customer_key")})
    per_customer = lines.groupBy("report_month", "customer_key").agg(
        F.count_distinct("order_id").alias("orders"),
        _money_sum(kept("net_sales")).alias("revenue"),
    )
    # The same customer and attributes twice is one customer; this grouping needs no shuffle.
    customer_months = (
        per_customer.join(customers.select(key_bytes("customer_key"), *attributes), "customer_key")
        .groupBy("report_month", "customer_key", *attributes)
        .agg(F.max("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )
    table = customer_months.groupBy("report_month", *attributes).agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("orders") > 1).alias("customers_with_multiple_orders_in_month"),
        F.sum("orders").alias("total_orders"),
        _money_sum("revenue").alias("total_revenue"),
    )
    return with_loaded_at(table, params)


def agg_customer_cohort(
    sales: DataFrame, customers: DataFrame, params: MartParams, latest_month: Column | None = None
) -> DataFrame:
    """First-purchase month x region x months since, 0 to 11, up to the latest month with sales.

    ``latest_month`` is given when ``sales`` holds only some months.

    A cohort without a region is listed, but its activity is never matched, so it reads 0 active.
    """
    cohort, offset = ["cohort_month", "region"], "months_since_acquisition"
    members = customers.filter(F.col("first_purchase_date").isNotNull()).select(
        key_bytes("customer_key"), "region", month_of("first_purchase_date").alias("cohort_month")
    )
    sizes = members.groupBy(*cohort).agg(F.count_distinct("customer_key").alias("cohort_size"))

    active_months = sales.select(key_bytes("customer_key"), month_of("date_key").alias("activity_month")).distinct()
    active = (
        members.join(active_months, "customer_key")
        .withColumn(offset, months_apart(F.col("activity_month"), F.col("cohort_month")))
        .filter(F.col(offset).between(0, COHORT_MONTHS - 1))
        .groupBy(*cohort, offset)
        .agg(F.count_distinct("customer_key").alias("active_customers"))
    )

    if latest_month is None:
        latest_month = sales.agg(month_of(F.max("date_key")).alias("latest_month")).scalar()
    calendar = (
        sizes.withColumn(offset, F.explode(F.sequence(F.lit(0), F.lit(COHORT_MONTHS - 1))))
        .withColumn("activity_month", F.add_months("cohort_month", F.col(offset)))
        .filter(F.col("activity_month") <= latest_month)
    )
    table = (
        calendar.join(active, [*cohort, offset], "left")
        .withColumn("active_customers", F.coalesce("active_customers", F.lit(0)))
        .select(
            "cohort_month",
            "activity_month",
            F.col(offset).cast("bigint").alias(offset),
            "region",
            "cohort_size",
            "active_customers",
            percent_half_up("active_customers", "cohort_size").alias("retention_rate"),
        )
    )
    return with_loaded_at(table, params).orderBy("cohort_month", "region", offset)


def agg_sales_daily(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    channels: DataFrame,
    campaigns: DataFrame,
    params: MartParams,
) -> DataFrame:
    """Day x category x sub-category x region x channel x campaign type.

    Refunded lines count as orders but add nothing to the sums, as in the daily growth table.

    Groups are many and small, so that neither their lines nor their orders shrink on the way: all lines of a group meet at
    once, and their orders are counted there, instead of one shuffle by group and order and one by group.
    """
    keys = ["category", "sub_category", "region", "channel_name", "campaign_type"]
    sums = {c: kept(c) for c in ("net_sales", "quantity", "discount_amount", "gross_profit")}
    lines = (
        sales.select(
            "date_key", "order_id", "channel_key", "campaign_key", key_bytes("customer_key"), key_bytes("product_key"),
            *[value.alias(c) for c, value in sums.items()],
        )
        .join(customers.select(key_bytes("customer_key"), "region"), "customer_key")
        .join(products.select(key_bytes("product_key"), "category", "sub_category"), "product_key")
        .join(channels.select("channel_key", "channel_name"), "channel_key")
        .join(campaigns.select("campaign_key", "campaign_type"), "campaign_key")
    )
    lines = lines.withColumnRenamed("date_key", "report_date").drop("channel_key", "campaign_key", "customer_key", "product_key")
    table = lines.repartition("report_date", *keys).groupBy("report_date", *keys).agg(
        F.count_distinct("order_id").alias("total_orders"),
        _money_sum("net_sales").alias("total_revenue"),
        F.sum("quantity").alias("total_units"),
        F.sum("discount_amount").cast("decimal(38,9)").alias("total_discount"),
        _money_sum("gross_profit").alias("gross_profit"),
    )
    measures = ["total_revenue", "total_orders", "total_units", "total_discount", "gross_profit"]
    return with_loaded_at(table.select("report_date", *keys, *_zero_filled(*measures)), params)


def customers_and_orders(
    rows: DataFrame, keys: list[str], flags: tuple[str, ...] = (), sums: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct customers, distinct orders and sums per group, exactly.

    ``rows`` has customer_key, order_id, revenue, gross_profit and the further ``sums``. ``flags`` are
    booleans of a customer within a group; each yields the number of customers that carry it.

    Two grouping sets, per customer and per order, instead of one Expand branch per distinct count
    plus one for the sums. Both are reduced before the shuffle, and a large group is spread by
    customer and order before its few totals meet. Sums go with the orders only.
    """
    of_order = F.grouping("order_id") == 0
    entities = rows.groupingSets(
        [[*keys, "customer_key"], [*keys, "order_id"]],
        *[F.col(k) for k in keys],
        F.col("customer_key"),
        F.col("order_id"),
    ).agg(
        (F.grouping("order_id") == 1).alias("is_customer"),
        F.sum(F.when(of_order, F.col("revenue"))).alias("revenue"),
        F.sum(F.when(of_order, F.col("gross_profit"))).alias("profit"),
        *[F.max(F.when(~of_order, F.col(f))).alias(f) for f in flags],
        *[F.sum(F.when(of_order, F.col(s))).alias(s) for s in sums],
    )
    is_customer = F.col("is_customer")
    return entities.groupBy(*keys).agg(
        F.count(F.when(is_customer, F.col("customer_key"))).alias("total_customers"),
        *[F.count_if(is_customer & F.col(f)).alias(f) for f in flags],
        F.count(F.when(~is_customer, F.col("order_id"))).alias("total_orders"),
        _money_sum(F.when(~is_customer, F.col("revenue"))).alias("total_revenue"),
        _money_sum(F.when(~is_customer, F.col("profit"))).alias("gross_profit"),
        *[F.sum(F.when(~is_customer, F.col(s))).alias(s) for s in sums],
    )


def kept(column: str) -> Column:
    """The value on lines known not to be refunded; NULL on refunded lines and where that is unknown."""
    return F.when(~F.col("is_refunded"), F.col(column))


def _sales_by_region(
    sales: DataFrame, customers: DataFrame, period_name: str, period: Column, first_period: Column
) -> DataFrame:
    """Sales per period, channel, campaign and customer region. A customer is new in the period of
    the first purchase and returning in any other; the unknown customer is neither."""
    keys = [period_name, "channel_key", "campaign_key", "region"]
    first = customers.select(key_bytes("customer_key"), "region", first_period.alias("first_period"))
    lines = (
        sales.select(
            period.alias(period_name),
            "channel_key",
            "campaign_key",
            key_bytes("customer_key"),
            "order_id",
            kept("net_sales").alias("revenue"),
            kept("gross_profit").alias("gross_profit"),
        )
        .join(first, "customer_key")
        .withColumns(
            {
                "new_customers": F.col("first_period") == F.col(period_name),
                "returning_customers": F.col("first_period") != F.col(period_name),
            }
        )
    )
    return customers_and_orders(lines, keys, flags=("new_customers", "returning_customers"))


def _with_names(rows: DataFrame, channels: DataFrame, campaigns: DataFrame) -> DataFrame:
    return rows.join(channels.select("channel_key", "channel_name"), "channel_key").join(
        campaigns.select("campaign_key", "campaign_id", "campaign_name", "campaign_type"), "campaign_key"
    )


def _spend() -> list[Column]:
    acquisition = F.when(F.col("campaign_objective") == "acquisition", F.col("ad_spend")).otherwise(0)
    return [
        _money_sum("ad_spend").alias("total_ad_spend"),
        _money_sum(acquisition).alias("acquisition_cost"),
    ]


def _funnel() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions")]


def _money_sum(column: str | Column) -> Column:
    return F.sum(column).cast("decimal(38,9)")


def _zero_filled(*columns: str) -> list[Column]:
    return [F.coalesce(c, F.lit(0)).alias(c) for c in columns]
