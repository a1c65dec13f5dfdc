"""Every query by name, each from the supplied tables up: (spark, folder) -> DataFrame."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import key_bytes, month_of, timestamp_literal
from starmart.operators import checks, facts, measures, staging, states
from starmart.operators.measures import measure
from starmart.params import UNATTRIBUTED, UNKNOWN, MartParams
from starmart.plans.incremental import IncrementalMart
from starmart.plans.ingest import ingest, load
from starmart.plans.mart import AGGREGATES, DIMENSIONS, FACTS, STAGING, Mart
from starmart.session import shared_folder
from starmart.sources import normalize, readers, sinks, upsert, watermark
from starmart.sources.buckets import bucketed
from starmart.sources.registry import DATASETS, FULL
from starmart.sources.supplied import SuppliedTables
from starmart.sources.versions import Store

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = dt.datetime(2024, 6, 15, 6, tzinfo=dt.timezone.utc)
PARAMS = MartParams(as_of=dt.date(2024, 6, 15), run_ts=RUN_TS)
MONTH = "report_month"


def mart(spark: SparkSession, folder: str) -> Mart:
    return Mart(spark, SuppliedTables(spark, folder), PARAMS)


def _of_mart(build: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, folder: build(mart(spark, folder))


def _table(name: str) -> Query:
    return _of_mart(lambda m: m.table(name).drop("loaded_at"))


def dim_date_activity(m: Mart) -> DataFrame:
    """The calendar with the number of order lines and ad records that fall on each of its days."""
    lines = m["fact_sales"].groupBy("date_key").agg(F.count("*").alias("sales_lines"))
    ads = m["fact_marketing"].groupBy("date_key").agg(F.count("*").alias("ad_records"))
    return (
        m["dim_date"]
        .drop("loaded_at")
        .join(lines, "date_key", "left")
        .join(ads, "date_key", "left")
        .fillna(0, ["sales_lines", "ad_records"])
    )


def kpi_sales(m: Mart) -> DataFrame:
    rows = m["agg_growth_daily"].withColumn(MONTH, month_of("report_date"))
    names = ("revenue", "orders", "average_order_value", "gross_profit", "gross_margin")
    return measure(rows, *names, by=[MONTH, "channel_name"], table="agg_growth_daily")


def kpi_unit_economics(m: Mart) -> DataFrame:
    rows = measures.monthly_sales(m["fact_sales"])
    return measure(
        rows, "units", "average_selling_price", "revenue_per_customer", "orders_per_customer", by=[MONTH], table="monthly_sales"
    )


def kpi_discount(m: Mart) -> DataFrame:
    rows = measures.discounts(m["fact_sales"]).join(
        m.lookup("dim_products").select("product_key", "category"), "product_key"
    )
    return measure(rows, "discount_rate", "discount_frequency", by=[MONTH, "category"], table="discounts")


def kpi_customers(m: Mart) -> DataFrame:
    rows = measures.monthly_customers(m["fact_sales"], m.lookup("dim_customers"))
    return measure(rows, "customers", "new_customer_count", "returning_customer_count", by=[MONTH], table="monthly_customers")


def kpi_repeat_rate(m: Mart) -> DataFrame:
    customers = measures.monthly_customers(m["fact_sales"], m.lookup("dim_customers"))
    over_time = measure(customers, "repeat_purchase_rate", by=[MONTH], table="monthly_customers")
    within_month = measure(m["agg_customer_segment"], "same_month_repeat_rate", by=[MONTH], table="agg_customer_segment")
    return over_time.join(within_month, MONTH, "full_outer")


def kpi_retention(m: Mart) -> DataFrame:
    names = ("cohort_customers", "active_cohort_customers", "retention")
    return measure(m["agg_customer_cohort"], *names, by=["cohort_month", "months_since_acquisition"], table="agg_customer_cohort")


def kpi_segment(m: Mart) -> DataFrame:
    names = ("customers", "average_customer_revenue", "purchase_frequency")
    return measure(m["agg_customer_segment"], *names, by=[MONTH, "region"], table="agg_customer_segment")


def kpi_segment_share(m: Mart) -> DataFrame:
    by = [MONTH, "region", "customer_status"]
    return measures.share(m["agg_customer_segment"], "total_revenue", by, [MONTH], "segment_revenue_share")


def kpi_lifetime(m: Mart) -> DataFrame:
    return measures.average_lifetime_revenue(m["dim_customers"], by=["region", "customer_status"])


def kpi_acquisition(m: Mart) -> DataFrame:
    rows = measures.acquisition_results(m["fact_sales"], m["fact_marketing"], m.lookup("dim_customers"))
    names = ("ad_spend", "acquisition_spend", "new_customer_count", "customer_acquisition_cost")
    return measure(rows, *names, by=[MONTH], table="acquisition_results")


def kpi_roas(m: Mart) -> DataFrame:
    rows = (
        measures.campaign_results(m["fact_sales"], m["fact_marketing"])
        .join(m.lookup("dim_campaigns").select("campaign_key", "campaign_id"), "campaign_key")
        .join(m.lookup("dim_channels").select("channel_key", "channel_name"), "channel_key")
    )
    names = ("ad_spend", "campaign_revenue", "return_on_ad_spend", "profit_on_ad_spend")
    return measure(rows, *names, by=[MONTH, "campaign_id", "channel_name"], table="campaign_results")


def kpi_funnel(m: Mart) -> DataFrame:
    rows = m["agg_channel_funnel_daily"].withColumn(MONTH, month_of("date_key"))
    names = (
        "ad_spend", "impression_count", "click_count", "conversion_count",
        "click_through_rate", "conversion_rate", "cost_per_conversion",
    )
    return measure(rows, *names, by=[MONTH, "channel_name"], table="agg_channel_funnel_daily")


def kpi_campaign_region(m: Mart) -> DataFrame:
    """Campaign revenue per region: the one campaign measure that has regions, since spend has none."""
    return measure(m["agg_campaign_performance"], "campaign_revenue", by=[MONTH, "campaign_id", "region"], table="agg_campaign_performance")


def check_kpi_rules(m: Mart) -> DataFrame:
    """Seven rules over five tables, which all start from the same staged sales."""
    m = _staged_in_buckets(m, _fresh_folder(m)[0])
    return checks.kpi_rules(
        m["agg_growth_daily"],
        m["agg_customer_segment"],
        m["agg_customer_cohort"],
        measures.acquisition_results(m["fact_sales"], m["fact_marketing"], m.lookup("dim_customers")),
        measures.campaign_results(m["fact_sales"], m["fact_marketing"]),
        m["fact_sales"],
    )


def _staged_in_buckets(m: Mart, root: str) -> Mart:
    """The mart with its typed sales written once, in buckets by order, and the ids that its dimensions do not have exactly once.

    Staging and all that follows then reads the buckets, and finds customers, products and campaigns without a shuffle of the
    lines; tables of the sales alone take their campaigns from those that the lines name.
    """
    typed = _written(staging.keyed_by_order(staging.typed_sales(m.raw["raw_sales"])), f"{root}/typed_sales")
    odd = {
        column: _written(facts.exceptions(typed, m[name], column), f"{root}/{name}-odd")
        for column, name in (("customer_id", "dim_customers"), ("product_id", "dim_products"), ("campaign_id", "dim_campaigns"))
    }
    campaigns, special = m["dim_campaigns"], F.col("campaign_id").isin(UNKNOWN, UNATTRIBUTED)
    named = campaigns.filter(~special).join(typed.select("campaign_id").distinct(), "campaign_id", "left_semi")
    used = {"dim_campaigns": _written(campaigns.filter(special).unionByName(named), f"{root}/dim_campaigns-used")}
    return Mart(m.spark, m.raw, m.params, {**m.built, "stg_sales": staging.stg_keyed_sales(typed)}, m.row_counts, odd, used)


def _of_buckets(build: Callable[[Mart], DataFrame]) -> Query:
    return _of_mart(lambda m: build(_staged_in_buckets(m, _fresh_folder(m)[0])))


def _check(kind: str) -> Query:
    return _of_mart(lambda m: checks.report(checks.checks_of(kind), m))


def ingest_full(m: Mart) -> DataFrame:
    """A full load of the customers, as it is written but for the stamp."""
    return normalize.prepare(m.raw["raw_customers"], DATASETS["customers"].schema, RUN_TS).drop("_ingested_at")


def ingest_incremental(m: Mart) -> DataFrame:
    """The sales an incremental load reads behind a watermark of 2024-06-01."""
    dataset = DATASETS["sales"]
    recent = readers.since(dataset.watermark_column, T.DateType(), dt.datetime(2024, 6, 1))
    return normalize.prepare(m.raw["raw_sales"].filter(recent), dataset.schema, RUN_TS).drop("_ingested_at")


def ingest_normalize(m: Mart) -> DataFrame:
    """Sales that arrive as text, some of it not a number or not a date."""
    quantity, text = F.col("quantity"), F.col("quantity").cast("string")
    arrived = m.raw["raw_sales"].select(
        "order_id",
        "product_id",
        F.when(quantity % 10 == 0, F.concat(text, F.lit(".0")))
        .when(quantity % 7 == 0, "n/a")
        .when(quantity % 11 == 0, F.concat(text, F.lit(".5")))
        .otherwise(text)
        .alias("quantity"),
        F.when(quantity % 9 == 0, "abc").otherwise(F.col("price").cast("string")).alias("price"),
        F.when(quantity % 13 == 0, "2024-02-30").otherwise(F.col("order_date").cast("string")).alias("order_date"),
        F.lit("kept").alias("extra_column"),
    )
    return normalize.normalize_types(arrived, DATASETS["sales"].schema)


def ingest_column_names(m: Mart) -> DataFrame:
    """Ad records whose source spells its column names differently."""
    rows = m.raw["raw_marketing"].drop("_ingested_at")
    return normalize.normalize_names(rows.toDF(*[f" {c.replace('_', '-', 1).title()} " for c in rows.columns]))


def ingest_dedup_rerun(m: Mart) -> DataFrame:
    """Staging after a batch behind the watermark was loaded a second time."""
    rows = m.raw["raw_sales"]
    recent = readers.since("order_date", T.DateType(), dt.datetime(2024, 6, 1))
    rerun = rows.filter(recent).withColumn("_ingested_at", F.lit("2030-01-01").cast("timestamp_ntz"))
    return staging.stg_sales(rows.unionByName(rerun))


def _text_sales(m: Mart) -> DataFrame:
    """All columns of the sales as text, some values not numbers or not dates."""
    rows = m.raw["raw_sales"].drop("_ingested_at")
    quantity = F.col("quantity")
    spoiled = {
        "quantity": F.when(quantity % 7 == 0, "n/a").otherwise(quantity.cast("string")),
        "price": F.when(quantity % 9 == 0, "abc").otherwise(F.col("price").cast("string")),
        "order_date": F.when(quantity % 13 == 0, "2024-02-30")
        .when(quantity % 5 == 0, F.date_format("order_date", "MM/dd/yyyy"))
        .otherwise(F.col("order_date").cast("string")),
    }
    return rows.select(*[spoiled.get(c, F.col(c).cast("string")).alias(c) for c in rows.columns])


def ingest_rejects(m: Mart) -> DataFrame:
    """Values per column that came, and that did not parse, when every column of the sales is text."""
    return normalize.rejects(_text_sales(m), DATASETS["sales"].schema)


def ingest_normalize_all(m: Mart) -> DataFrame:
    """Every column of the sales, from text to its declared type."""
    return normalize.normalize_types(_text_sales(m), DATASETS["sales"].schema)


def _fresh_folder(m: Mart) -> tuple[str, readers.Source]:
    root = f"{shared_folder(m.spark, fallback='/tmp/checkpoints')}/ingest-{uuid.uuid4().hex}"
    return root, readers.Source(root=f"{root}/source")


def _publish(source: readers.Source, dataset: str, rows: DataFrame) -> None:
    rows.drop("_ingested_at").write.mode("overwrite").parquet(f"{source.root}/{DATASETS[dataset].source}")


def ingest_run_full(m: Mart) -> DataFrame:
    """The stored customers after a full load of some, one of all, and one of none."""
    root, source = _fresh_folder(m)
    rows, dataset = m.raw["raw_customers"], DATASETS["customers"]
    for batch in (rows.filter("age > 40"), rows, rows.limit(0)):
        _publish(source, "customers", batch)
        ingest(m.spark, dataset, source, root, RUN_TS)
    stored = readers.read_raw(m.spark, root, dataset)
    return stored.withColumn("_ingested_at", F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss"))


def ingest_run_incremental(m: Mart) -> DataFrame:
    """Stored sales per day after two loads of the same source, with the watermark that the log then holds."""
    root, source = _fresh_folder(m)
    dataset = DATASETS["sales"]
    _publish(source, "sales", m.raw["raw_sales"])
    for _ in range(2):
        ingest(m.spark, dataset, source, root, RUN_TS)
    per_day = readers.read_raw(m.spark, root, dataset).groupBy("order_date").agg(F.count("*").alias("stored_rows"))
    log = watermark.watermark_log(m.spark, root)
    return per_day.select(
        "order_date",
        "stored_rows",
        F.date_format(F.lit(watermark.get_watermark(log, dataset.target)), "yyyy-MM-dd").alias("watermark"),
        F.lit(log.count()).alias("log_rows"),
    )


def ingest_run_rejects(m: Mart) -> DataFrame:
    """What a load of the sales as text observed while it wrote them: values per column that came and that did not parse."""
    root, source = _fresh_folder(m)
    _publish(source, "sales", _text_sales(m))
    loaded = load(m.spark, dataclasses.replace(DATASETS["sales"], load_type=FULL), source, root, RUN_TS)
    return m.spark.createDataFrame([(c, *n) for c, n in loaded.rejects.items()], "column_name string, arrived long, rejected long")


def ingest_run_renamed(m: Mart) -> DataFrame:
    """Staged sales of two batches, the second with its date as text under another name."""
    root, dataset = _fresh_folder(m)[0], DATASETS["sales"]
    rows = m.raw["raw_sales"].drop("_ingested_at")
    odd = F.crc32("order_id") % 2 == 1
    renamed = rows.filter(odd).withColumn("Order Date", F.date_format("order_date", "M/d/yyyy")).drop("order_date")
    for batch in (rows.filter(~odd), renamed):
        prepared = normalize.prepare(batch, dataset.schema, RUN_TS)
        sinks.write_batch(prepared, root, dataset.target, dataset.load_type, dataset.watermark_column)
    return staging.stg_sales(readers.read_raw(m.spark, root, dataset))


def audit_loaded_at(m: Mart) -> DataFrame:
    """Rows per table and load time of what the mart stamps."""
    names = ("dim_campaigns", "dim_customers", "fact_sales", "fact_marketing", "agg_channel_funnel_daily")
    parts = [
        m[name]
        .groupBy(F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("table_name", F.lit(name))
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)


def cohort_order(m: Mart) -> DataFrame:
    """The cohort table's own order as positions, numbered within each sorted part and by the parts before it."""
    keys = ("cohort_month", "region", "months_since_acquisition")
    ordered = m["agg_customer_cohort"].select(*keys, F.monotonically_increasing_id().alias("at"))
    return states.numbered(_written(ordered, f"{_fresh_folder(m)[0]}/ordered")).withColumnRenamed("id", "position")


def watermark_lookup(m: Mart) -> DataFrame:
    """The current watermarks after one sales load per month and one ad load per day."""
    log = [
        m.raw[target]
        .groupBy(F.trunc(column, every).alias("batch") if every else F.col(column).alias("batch"))
        .agg(F.max(column).cast("timestamp").alias("last_loaded_date"))
        .select(F.lit(target).alias("table_name"), "last_loaded_date", timestamp_literal(RUN_TS).alias("loaded_at"))
        for target, column, every in (("raw_sales", "order_date", "month"), ("raw_marketing", "date", None))
    ]
    targets = m.spark.createDataFrame([(d.target,) for d in DATASETS.values()], "table_name string")
    current = watermark.current_watermarks(log[0].unionByName(log[1]), targets)
    return current.withColumn("last_loaded_date", F.date_format("last_loaded_date", "yyyy-MM-dd HH:mm:ss"))


def _written(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written and read again; those that ``staging.keyed_by_order`` gave are in buckets by that key."""
    if staging.SPREAD in rows.columns:
        return bucketed(rows, path, *staging.BUCKET)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ingest_upsert(m: Mart) -> DataFrame:
    """Staged sales after three batches that overlap, the older copies of some lines coming last."""
    store, rows = Store(m.spark, _fresh_folder(m)[0]), m.raw["raw_sales"]
    third = F.pmod(F.crc32("order_id"), F.lit(3))
    older = rows.filter(third == 0).withColumns({"_ingested_at": F.lit("1980-01-01").cast("timestamp_ntz"), "price": F.col("price") + 1})
    for batch in (rows.filter(third < 2), rows.filter(third > 0), older):
        change = store.begin()
        upsert.upsert(change, upsert.SALES, batch, buckets=16)
        change.commit()
    return upsert.staged(store.begin(), upsert.SALES, upsert.SALES.typed(rows).schema)


LATE = "order_date BETWEEN '2021-05-03' AND '2021-06-20' AND crc32(order_id) % 10 = 0"


def refresh_months(m: Mart) -> DataFrame:
    """Rows, revenue and customers or orders per aggregate and month after a build and a refresh with late lines and ads.

    The build lacks some orders of two months and one day of ads, and has wrong copies of other orders, at another
    date and of another customer; the refresh brings what is missing and the right copies.
    """
    sales, ads = m.raw["raw_sales"], m.raw["raw_marketing"]
    wrong = sales.filter(f"{LATE} AND crc32(order_id) % 20 = 0").withColumns(
        {"order_date": F.lit("2020-02-29").cast("date"), "customer_id": F.lit("C7"), "_ingested_at": F.lit("1980-01-01").cast("timestamp_ntz")}
    )
    late_ads = "date = '2024-01-15'"
    mart = IncrementalMart(m.spark, m.raw, f"{_fresh_folder(m)[0]}/mart", m.params, buckets=16)
    mart.refresh(sales.filter(f"NOT ({LATE})").unionByName(wrong), ads.filter(f"NOT ({late_ads})"))
    mart.refresh(sales.filter(LATE), ads.filter(late_ads))

    def per_month(name: str, date: str, money: str, count: str) -> DataFrame:
        return (
            mart.table(name)
            .groupBy(F.lit(name).alias("table_name"), month_of(date).alias(MONTH))
            .agg(F.count("*").alias("row_count"), F.sum(money).cast("decimal(38,9)").alias("amount"), F.sum(count).alias("counted"))
        )

    parts = [
        per_month("fact_sales", "date_key", "net_sales", "quantity"),
        per_month("fact_marketing", "date_key", "ad_spend", "clicks"),
        per_month("agg_growth_daily", "report_date", "total_revenue", "new_customers"),
        per_month("agg_campaign_performance", MONTH, "total_ad_spend", "new_customers"),
        per_month("agg_channel_performance", MONTH, "total_revenue", "total_customers"),
        per_month("agg_channel_funnel_daily", "date_key", "total_ad_spend", "total_clicks"),
        per_month("agg_customer_segment", MONTH, "total_revenue", "customers_with_multiple_orders_in_month"),
        per_month("agg_sales_daily", "report_date", "total_revenue", "total_units"),
        per_month("agg_customer_cohort", "cohort_month", "cohort_size", "active_customers"),
        per_month("dim_customers", "first_purchase_date", "lifetime_revenue", "lifetime_orders"),
    ]
    return reduce(DataFrame.unionByName, parts)


def rollup_distinct(m: Mart) -> DataFrame:
    """Distinct customers and orders per month, channel, campaign and month, and in all, from bitmaps beside the facts."""
    root = _fresh_folder(m)[0]
    m = _staged_in_buckets(m, root)
    # four jobs read these columns
    fact = _written(m["fact_sales"].select(*states.KEYS, key_bytes("customer_key"), "order_id"), f"{root}/fact")
    levels = {"month": [MONTH], "channel": ["channel_key"], "month_campaign": [MONTH, "campaign_key"], "all": []}
    counted = []
    for column, name in (("customer_key", "total_customers"), ("order_id", "total_orders")):
        seen = _written(states.first_seen(fact, column), f"{root}/{column}")
        state = _written(states.distinct_state(fact, column, states.numbered(seen)), f"{root}/{column}-state")
        counted.append(states.rolled_up(state.withColumn(MONTH, month_of("date_key")), levels, name))
    keys = ["level", MONTH, "channel_key", "campaign_key"]
    customers, orders = counted
    same = [customers[k].eqNullSafe(orders[k]) for k in keys]
    return customers.join(orders, same).select(*[customers[k] for k in keys], "total_customers", "total_orders")


def cohort_activity(m: Mart) -> DataFrame:
    """The cohort table from activity bits: those up to 2021, written, united with those of the months since."""
    root = _fresh_folder(m)[0]
    m = _staged_in_buckets(m, root)
    fact = m["fact_sales"]
    old = _written(states.activity_state(fact.filter("date_key < '2021-01-01'"), m.params), f"{root}/old")
    new = _written(states.activity_state(fact.filter("date_key >= '2021-01-01'"), m.params), f"{root}/new")
    state = _written(states.merged_activity(old, new, m.params), f"{root}/state")
    return states.cohorts_of_activity(state, m.lookup("dim_customers"), m.params).drop("loaded_at")


# tables whose lines would cross three shuffles or more
LEAN = ("fact_sales", "agg_growth_daily", "agg_campaign_performance", "agg_sales_daily")

QUERIES: dict[str, Query] = {
    # A bare calendar reads no data, so the date dimension is queried with what falls on its days.
    **{name: _table(name) for name in STAGING + DIMENSIONS + FACTS + AGGREGATES if name != "dim_date"},
    **{name: _of_buckets(lambda m, name=name: m[name].drop("loaded_at")) for name in LEAN},
    **{build.__name__: _of_buckets(build) for build in (kpi_sales, kpi_campaign_region)},
    **{
        build.__name__: _of_mart(build)
        for build in (
            dim_date_activity,
            kpi_unit_economics,
            kpi_discount,
            kpi_customers,
            kpi_repeat_rate,
            kpi_retention,
            kpi_segment,
            kpi_segment_share,
            kpi_lifetime,
            kpi_acquisition,
            kpi_roas,
            kpi_funnel,
        )
    },
    "check_not_null": _check(checks.NOT_NULL),
    "check_unique": _check(checks.UNIQUE),
    "check_accepted_values": _check(checks.ACCEPTED),
    "check_relationships": _check(checks.RELATIONSHIPS),
    "check_unique_combination": _check(checks.COMBINATION),
    "check_expression": _check(checks.EXPRESSION),
    "check_equal_rowcount": _check(checks.ROWCOUNT),
    **{
        build.__name__: _of_mart(build)
        for build in (
            check_kpi_rules,
            ingest_full,
            ingest_incremental,
            ingest_normalize,
            ingest_column_names,
            ingest_dedup_rerun,
            ingest_rejects,
            ingest_normalize_all,
            ingest_run_full,
            ingest_run_incremental,
            ingest_run_renamed,
            audit_loaded_at,
            cohort_order,
            watermark_lookup,
            ingest_upsert,
            ingest_run_rejects,
            refresh_months,
            rollup_distinct,
            cohort_activity,
        )
    },
}
