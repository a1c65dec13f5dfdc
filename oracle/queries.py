"""The SQL of every registered query, columns named as in the Spark result."""

from __future__ import annotations

from oracle.tables import TABLES, quotient, staged_sales, with_tables

MART = [name for name in TABLES if name.startswith(("stg_", "dim_", "fact_", "agg_")) and name != "dim_date"]


def total(column: str, alias: str, scale: int = 9) -> str:
    return f"cast(sum({column}) as decimal(38,{scale})) as {alias}"


def whole(column: str, alias: str) -> str:
    return f"cast(sum({column}) as bigint) as {alias}"


def rate(top: str, bottom: str, alias: str) -> str:
    return f"{quotient(f'sum({top})', f'sum({bottom})')} as {alias}"


MONTH = "cast(date_trunc('month', {}) as date) as report_month"

HELPERS = {
    "month_customers": f"""
select report_month, count(*) as total_customers,
       count(case when first_month = report_month then 1 end) as new_customers,
       count(case when first_month < report_month then 1 end) as returning_customers
from (select distinct {MONTH.format("f.date_key")}, f.customer_key,
             date_trunc('month', c.first_purchase_date) as first_month
      from fact_sales f join dim_customers c on f.customer_key = c.customer_key)
group by report_month""",
    "month_spend": f"""
select {MONTH.format("date_key")}, sum(ad_spend) as total_ad_spend,
       coalesce(sum(case when campaign_objective = 'acquisition' then ad_spend end), 0) as acquisition_cost
from fact_marketing group by 1""",
    "acquisition": """
select coalesce(c.report_month, s.report_month) as report_month, c.new_customers, s.total_ad_spend, s.acquisition_cost
from month_customers c full outer join month_spend s on c.report_month = s.report_month""",
    "campaign_money": f"""
select coalesce(s.report_month, m.report_month) as report_month, coalesce(s.campaign_key, m.campaign_key) as campaign_key,
       coalesce(s.channel_key, m.channel_key) as channel_key, total_revenue, gross_profit, total_ad_spend
from (select {MONTH.format("date_key")}, campaign_key, channel_key,
             sum(case when not is_refunded then net_sales end) as total_revenue,
             sum(case when not is_refunded then gross_profit end) as gross_profit
      from fact_sales group by 1, 2, 3) s
full outer join (select {MONTH.format("date_key")}, campaign_key, channel_key, sum(ad_spend) as total_ad_spend
                 from fact_marketing group by 1, 2, 3) m
  on s.report_month = m.report_month and s.campaign_key = m.campaign_key and s.channel_key = m.channel_key""",
    "sold_lines": f"select *, {MONTH.format('date_key')} from fact_sales",
    "stamped_sales": "select * replace (timestamp '2024-06-15 06:00:00' as _ingested_at) from raw_sales",
    "sales_and_rerun": """
select * from raw_sales
union all
select * replace (timestamp '2030-01-01' as _ingested_at) from raw_sales where order_date >= date '2024-05-29'""",
}

SELECTS = {
    "dim_date_activity": """
select d.*, coalesce(s.n, 0) as sales_lines, coalesce(m.n, 0) as ad_records
from dim_date d
left join (select date_key, count(*) as n from fact_sales group by 1) s on d.date_key = s.date_key
left join (select date_key, count(*) as n from fact_marketing group by 1) m on d.date_key = m.date_key""",
    "kpi_sales": f"""
select {MONTH.format("report_date")}, channel_name, {total("total_revenue", "revenue")},
       {whole("total_orders", "orders")}, {rate("total_revenue", "total_orders", "average_order_value")},
       {total("gross_profit", "gross_profit")}, {rate("gross_profit", "total_revenue", "gross_margin")}
from agg_growth_daily group by 1, 2""",
    "kpi_unit_economics": f"""
select {MONTH.format("date_key")}, cast(sum(case when not is_refunded then quantity end) as bigint) as units,
       {quotient("sum(case when not is_refunded then net_sales end)", "sum(case when not is_refunded then quantity end)")}
           as average_selling_price,
       {quotient("sum(case when not is_refunded then net_sales end)", "count(distinct customer_key)")}
           as revenue_per_customer,
       {quotient("count(distinct order_id)", "count(distinct customer_key)")} as orders_per_customer
from fact_sales group by 1""",
    "kpi_discount": f"""
select {MONTH.format("f.date_key")}, p.category, {rate("discount_amount", "gross_sales", "discount_rate")},
       {quotient("count(case when f.discount > 0 then 1 end)", "count(*)")} as discount_frequency
from fact_sales f join dim_products p on f.product_key = p.product_key group by 1, 2""",
    "kpi_customers": """
select report_month, total_customers as customers, new_customers as new_customer_count,
       returning_customers as returning_customer_count
from month_customers""",
    "kpi_repeat_rate": f"""
select coalesce(c.report_month, s.report_month) as report_month,
       {quotient("c.returning_customers", "c.total_customers")} as repeat_purchase_rate, s.same_month_repeat_rate
from month_customers c
full outer join (select report_month,
                 {rate("customers_with_multiple_orders_in_month", "total_customers", "same_month_repeat_rate")}
                 from agg_customer_segment group by 1) s on c.report_month = s.report_month""",
    "kpi_retention": f"""
select cohort_month, months_since_acquisition, {whole("cohort_size", "cohort_customers")},
       {whole("active_customers", "active_cohort_customers")}, {rate("active_customers", "cohort_size", "retention")}
from agg_customer_cohort group by 1, 2""",
    "kpi_segment": f"""
select report_month, region, {whole("total_customers", "customers")},
       {rate("total_revenue", "total_customers", "average_customer_revenue")},
       {rate("total_orders", "total_customers", "purchase_frequency")}
from agg_customer_segment group by 1, 2""",
    "kpi_segment_share": f"""
select s.report_month, s.region, s.customer_status, {quotient("s.revenue", "t.revenue")} as segment_revenue_share
from (select report_month, region, customer_status, sum(total_revenue) as revenue
      from agg_customer_segment group by 1, 2, 3) s
join (select report_month, sum(total_revenue) as revenue from agg_customer_segment group by 1) t
  on s.report_month = t.report_month""",
    "kpi_lifetime": f"""
select region, customer_status,
       {quotient("sum(lifetime_revenue)", "count(lifetime_revenue)")} as average_lifetime_revenue
from dim_customers group by 1, 2""",
    "kpi_acquisition": f"""
select report_month, cast(total_ad_spend as decimal(38,9)) as ad_spend,
       cast(acquisition_cost as decimal(38,9)) as acquisition_spend, new_customers as new_customer_count,
       {quotient("acquisition_cost", "new_customers")} as customer_acquisition_cost
from acquisition""",
    "kpi_roas": f"""
select m.report_month, k.campaign_id, h.channel_name, {total("total_ad_spend", "ad_spend")},
       {total("total_revenue", "campaign_revenue")}, {rate("total_revenue", "total_ad_spend", "return_on_ad_spend")},
       {rate("gross_profit", "total_ad_spend", "profit_on_ad_spend")}
from campaign_money m join dim_campaigns k on m.campaign_key = k.campaign_key
join dim_channels h on m.channel_key = h.channel_key
group by 1, 2, 3""",
    "kpi_funnel": f"""
select {MONTH.format("date_key")}, channel_name, {total("total_ad_spend", "ad_spend")},
       {whole("total_impressions", "impression_count")}, {whole("total_clicks", "click_count")},
       {whole("total_conversions", "conversion_count")},
       {rate("total_clicks", "total_impressions", "click_through_rate")},
       {rate("total_conversions", "total_clicks", "conversion_rate")},
       {rate("total_ad_spend", "total_conversions", "cost_per_conversion")}
from agg_channel_funnel_daily group by 1, 2""",
    "kpi_campaign_region": f"""
select report_month, campaign_id, region, {total("total_revenue", "campaign_revenue")}
from agg_campaign_performance group by 1, 2, 3""",
    "ingest_full": "select * from raw_customers",
    "ingest_incremental": """
select * exclude (_ingested_at) from raw_sales where order_date >= date '2024-05-29'""",
    "ingest_normalize": """
select order_id, product_id,
       case when quantity % 10 = 0 then quantity when quantity % 7 = 0 or quantity % 11 = 0 then null
            else quantity end as quantity,
       case when quantity % 9 <> 0 then price end as price,
       case when quantity % 13 <> 0 then order_date end as order_date, 'kept' as extra_column
from raw_sales""",
    "ingest_normalize_all": """
select * exclude (_ingested_at) replace (
    case when quantity % 7 <> 0 then quantity end as quantity, case when quantity % 9 <> 0 then price end as price,
    case when quantity % 13 <> 0 then order_date end as order_date)
from raw_sales""",
    "ingest_rejects": "\nunion all\n".join(
        f"select '{c}' as column_name, count({c}) as arrived, {lost} as rejected from raw_sales"
        for c, lost in {
            **dict.fromkeys(
                "order_id customer_id customer_status product_id product_name category ship_mode discount unit_cost "
                "refund_status revenue channel campaign_id".split(), "0"),
            "quantity": "count(*) filter (quantity % 7 = 0)",
            "price": "count(*) filter (quantity % 9 = 0)",
            "order_date": "count(*) filter (quantity % 13 = 0)",
        }.items()
    ),
    "ingest_run_full": "select *, '2024-06-15 06:00:00' as _ingested_at from raw_customers",
    "ingest_run_incremental": """
select order_date, count(*) * case when order_date >= last - 3 then 2 else 1 end as stored_rows,
       strftime(last, '%Y-%m-%d') as watermark, 2 as log_rows
from raw_sales, (select max(order_date) as last from raw_sales) where order_date >= date '2022-12-29'
group by order_date, last""",
    "ingest_run_renamed": staged_sales("stamped_sales"),
    "audit_loaded_at": "\nunion all\n".join(
        f"select '2024-06-15 06:00:00' as loaded_at, count(*) as row_count, '{name}' as table_name from {name}"
        for name in ("dim_campaigns", "dim_customers", "fact_sales", "fact_marketing", "agg_channel_funnel_daily")
    ),
    "cohort_order": """
select cohort_month, region, months_since_acquisition,
       row_number() over (order by cohort_month, region nulls first, months_since_acquisition) - 1 as position
from agg_customer_cohort""",
    "ingest_column_names": "select * exclude (_ingested_at) from raw_marketing",
    "ingest_dedup_rerun": staged_sales("sales_and_rerun"),
    "watermark_lookup": """
select t.table_name, strftime(coalesce(w.reached, timestamp '2023-01-01'), '%Y-%m-%d %H:%M:%S') as last_loaded_date
from (values ('raw_customers'), ('raw_sales'), ('raw_products'), ('raw_campaigns'), ('raw_channels'),
             ('raw_marketing')) t(table_name)
left join (select 'raw_sales' as table_name, cast(max(order_date) as timestamp) as reached from raw_sales
           union all select 'raw_marketing', cast(max(date) as timestamp) from raw_marketing) w
  on t.table_name = w.table_name""",
}


def labelled(kind: str, table: str, target: str, count: str) -> str:
    return f"select '{kind}' as \"check\", '{table}' as table_name, '{target}' as target, ({count}) as violations"


def columns_of(**tables: str) -> list[tuple[str, str]]:
    return [(table, column) for table, columns in tables.items() for column in columns.split()]


# The checked columns, keys, conditions and parents.
NOT_NULL = columns_of(
    stg_customers="customer_id", stg_products="product_id", stg_campaigns="campaign_id", stg_channels="channel_name",
    stg_sales="order_id product_id quantity refund_status", stg_marketing="ads_id ad_spend",
    dim_customers="customer_key customer_id", dim_products="product_key product_id",
    dim_campaigns="campaign_key campaign_id", dim_channels="channel_key channel_name", dim_date="date_key",
    fact_sales="sales_key date_key customer_key product_key channel_key campaign_key net_sales",
    fact_marketing="marketing_key date_key campaign_key channel_key ad_spend",
)
UNIQUE = columns_of(
    stg_customers="customer_id", stg_products="product_id", stg_campaigns="campaign_id", stg_channels="channel_name",
    stg_marketing="ads_id", dim_customers="customer_key customer_id", dim_products="product_key product_id",
    dim_campaigns="campaign_key campaign_id", dim_channels="channel_key channel_name", dim_date="date_key",
    fact_sales="sales_key", fact_marketing="marketing_key",
)
PARENTS = [
    ("dim_campaigns", "channel_key", "dim_channels"),
    ("fact_sales", "date_key", "dim_date"),
    ("fact_sales", "customer_key", "dim_customers"),
    ("fact_sales", "product_key", "dim_products"),
    ("fact_sales", "channel_key", "dim_channels"),
    ("fact_sales", "campaign_key", "dim_campaigns"),
    ("fact_marketing", "date_key", "dim_date"),
    ("fact_marketing", "campaign_key", "dim_campaigns"),
    ("fact_marketing", "channel_key", "dim_channels"),
]
CONDITIONS = [
    ("fact_sales", "net_sales >= 0"),
    ("fact_sales", "abs(gross_sales - discount_amount - net_sales) < 0.01"),
    ("fact_marketing", "ad_spend >= 0"),
    ("agg_customer_cohort", "retention_rate between 0 and 100"),
]
def months_of(table: str, date: str, money: str, count: str) -> str:
    return (
        f"select '{table}' as table_name, {MONTH.format(date)}, count(*) as row_count, "
        f"{total(money, 'amount')}, {whole(count, 'counted')} from {table} group by 2"
    )


SELECTS["refresh_months"] = "\nunion all\n".join(
    months_of(*row)
    for row in (
        ("fact_sales", "date_key", "net_sales", "quantity"),
        ("fact_marketing", "date_key", "ad_spend", "clicks"),
        ("agg_growth_daily", "report_date", "total_revenue", "new_customers"),
        ("agg_campaign_performance", "report_month", "total_ad_spend", "new_customers"),
        ("agg_channel_performance", "report_month", "total_revenue", "total_customers"),
        ("agg_channel_funnel_daily", "date_key", "total_ad_spend", "total_clicks"),
        ("agg_customer_segment", "report_month", "total_revenue", "customers_with_multiple_orders_in_month"),
        ("agg_sales_daily", "report_date", "total_revenue", "total_units"),
        ("agg_customer_cohort", "cohort_month", "cohort_size", "active_customers"),
        ("dim_customers", "first_purchase_date", "lifetime_revenue", "lifetime_orders"),
    )
)
SELECTS["ingest_run_rejects"] = SELECTS["ingest_rejects"]
SELECTS["ingest_upsert"] = "select * from stg_sales"
SELECTS["cohort_activity"] = "select * from agg_customer_cohort"
SELECTS["rollup_distinct"] = """
select 'month' as level, report_month, null as channel_key, null as campaign_key,
       count(distinct customer_key) as total_customers, count(distinct order_id) as total_orders from sold_lines group by 2
union all select 'channel', null, channel_key, null, count(distinct customer_key), count(distinct order_id) from sold_lines group by 3
union all select 'month_campaign', report_month, null, campaign_key, count(distinct customer_key), count(distinct order_id)
          from sold_lines group by 2, 4
union all select 'all', null, null, null, count(distinct customer_key), count(distinct order_id) from sold_lines"""
RULES: dict[str, list[tuple[str, str, str]]] = {
    "not_null": [(t, c, f"select count(*) - count({c}) from {t}") for t, c in NOT_NULL],
    "unique": [
        (t, c, f"select count(*) from (select {c} from {t} where {c} is not null group by {c} having count(*) > 1)")
        for t, c in UNIQUE
    ],
    "accepted_values": [
        ("stg_sales", "refund_status", "select count(*) from stg_sales where refund_status not in ('refunded', 'completed')")
    ],
    "relationships": [
        (t, c, f"select count(*) from {t} where {c} is not null and {c} not in (select {c} from {p} where {c} is not null)")
        for t, c, p in PARENTS
    ],
    "unique_combination": [
        ("stg_sales", "order_id,product_id",
         "select count(*) from (select 1 from stg_sales group by order_id, product_id having count(*) > 1)")
    ],
    "expression": [(t, e, f"select count(*) from {t} where not ({e})") for t, e in CONDITIONS],
    "equal_rowcount": [
        (t, o, f"select abs((select count(*) from {t}) - (select count(*) from {o}))")
        for t, o in (("fact_sales", "stg_sales"), ("fact_marketing", "stg_marketing"))
    ],
}


def kpi_rule_selects() -> list[str]:
    def identity(kind: str, table: str, value: str, truth: str, per: str, source: str, ratio: tuple[str, str], fact: str) -> str:
        top, bottom = (f"sum({c})" for c in ratio)
        return labelled(
            kind,
            table,
            f"{value} = {truth} / {per}",
            f"select count(*) from (select report_month, {quotient(top, bottom)} as v, {bottom} as p from {source} group by 1) "
            f"full outer join ({fact}) using (report_month) "
            "where (v is not null and (t is null or abs(v * p - t) > 0.01 + 1e-9 * abs(t))) "
            "or (v is null and p <> 0 and t is not null)",
        )

    growth = f"(select *, {MONTH.format('report_date')} from agg_growth_daily)"
    month = MONTH.format("date_key")
    money = f"select {month}, cast(sum(net_sales) filter (not is_refunded) as double) as t from fact_sales group by 1"
    bought = (
        f"select {month}, cast(count(distinct (customer_key, order_id)) filter (order_id is not null) as double) as t "
        "from fact_sales group by 1"
    )
    cohorts = "agg_customer_cohort"
    return [
        labelled("kpi_acquisition_cost", "fact_marketing", "cost and new customers > 0",
                 "select count(*) from acquisition where coalesce(acquisition_cost, 0) <= 0 or coalesce(new_customers, 0) <= 0"),
        labelled("kpi_retention", cohorts, "month 0 is 100 %",
                 f"select count(*) from {cohorts} where months_since_acquisition = 0 and retention_rate <> 100"),
        labelled("kpi_retention", cohorts, "no month after the latest sales",
                 f"select count(*) from {cohorts} where activity_month > (select max(date_key) from fact_sales)"),
        identity("kpi_order_value", "agg_growth_daily", "average_order_value", "fact_revenue", "orders",
                 growth, ("total_revenue", "total_orders"), money),
        identity("kpi_ad_return", "fact_sales", "return_on_ad_spend", "fact_revenue", "ad_spend",
                 "campaign_money", ("total_revenue", "total_ad_spend"), money),
        identity("kpi_frequency", "agg_customer_segment", "purchase_frequency", "fact_orders", "customers",
                 "agg_customer_segment", ("total_orders", "total_customers"), bought),
        labelled("kpi_segment_share", "agg_customer_segment", "shares of all sales of a month sum to 1",
                 "select count(*) from (select report_month, cast(sum(total_revenue) as double) as s from agg_customer_segment "
                 f"group by 1) full outer join ({money}) using (report_month) "
                 "where abs(s / nullif(t, 0) - 1) > 1e-6 or (s / nullif(t, 0) is null and t <> 0)"),
    ]


def oracle_sql() -> dict[str, str]:
    selects = {name: f"select * from {name}" for name in MART} | SELECTS
    for kind, rules in RULES.items():
        selects[f"check_{kind}"] = "\nunion all\n".join(labelled(kind, *rule) for rule in rules)
    selects["check_kpi_rules"] = "\nunion all\n".join(kpi_rule_selects())
    return {name: with_tables(select, HELPERS) for name, select in selects.items()}
