"""Keeping the mart up to date from batches, rewriting only the months, cohorts and buckets that a batch touches.

A late order line touches more than its own month. It may give its customer an earlier first purchase or another status,
and then every month in which that customer bought something shows it as new instead of returning, or in another segment;
and its customer's cohort, old and new, gains or loses a member or an active month. ``refresh`` derives this closure:

    changed lines -> their orders and customers -> purchase history -> customers whose first purchase or status moved
    -> the months those customers bought in; changed lines -> their months, before and after -> the months to rewrite

Every table is kept in parts of a ``Store``: staging and history by key hash, customers by customer hash, facts and
aggregates by month, cohorts by cohort month. A refresh reads the parts it needs, writes those that change and publishes
all tables as one version. A refresh that fails, or meets another writer's version, leaves everything as it was and is
run again. The first refresh of an empty store builds the mart.

The other dimensions are read as they are at the time of the refresh. When one of their sources has changed (a product's
category, a campaign's name), every month may be touched: start a new store.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import month_of, surrogate_key
from starmart.operators import aggregates, dimensions, facts
from starmart.operators.calendar import resolved_date_sql
from starmart.params import MartParams
from starmart.plans.mart import Mart
from starmart.sources import upsert
from starmart.sources.upsert import MARKETING, NEW, OLD, SALES, bucket, distinct_texts
from starmart.sources.versions import Change, Store

BY_MONTH = {
    "fact_sales": "date_key",
    "fact_marketing": "date_key",
    "agg_growth_daily": "report_date",
    "agg_campaign_performance": "report_month",
    "agg_channel_performance": "report_month",
    "agg_channel_funnel_daily": "date_key",
    "agg_customer_segment": "report_month",
    "agg_customer_cohort": "cohort_month",
    "agg_sales_daily": "report_date",
}
TABLES = ("stg_sales", "stg_marketing", "purchases", "dim_customers", *BY_MONTH)


def month_text(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM")


class IncrementalMart:
    """The mart in a store. ``raw`` gives the raw customers, products, campaigns and channels, and the schemas."""

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame], root: str, params: MartParams = MartParams(), buckets: int = 64
    ):
        self.mart, self.store, self.params, self.buckets = Mart(spark, raw, params), Store(spark, root), params, buckets

    def table(self, name: str) -> DataFrame:
        """A table as of the current version."""
        return self._read(self.store.begin(), name)

    def refresh(self, sales: DataFrame, marketing: DataFrame) -> dict[str, tuple[int, int]]:
        """Merge batches of raw sales and ad records. Per table, the parts rewritten and the parts it has now.

        A batch may repeat rows, bring older copies, or be empty.
        """
        change = self.store.begin()
        lines = upsert.upsert(change, SALES, sales, self.buckets)
        ads = upsert.upsert(change, MARKETING, marketing, self.buckets)
        moved = self._customers(change, lines)
        sales_months = self._fact(change, "fact_sales", lines, "order_date", surrogate_key("order_id", "product_id"))
        ad_months = self._fact(change, "fact_marketing", ads, "date", surrogate_key("ads_id"))
        first = distinct_texts(moved.filter("first_moved"), month_text("month"))
        status = distinct_texts(moved.filter("status_moved"), month_text("month"))
        customers, m, p = self._read(change, "dim_customers"), self.mart, self.params
        lookups = customers, m.lookup("dim_channels"), m.lookup("dim_campaigns")

        def rebuild(table: str, build, months: Iterable[str], *fact_tables: str) -> None:
            months = sorted(set(months))
            if months:
                rows = build(*[self._read(change, f, months) for f in fact_tables])
                change.replace(table, rows, month_text(BY_MONTH[table]), months)

        both = ("fact_sales", "fact_marketing")
        with_first = {*sales_months, *ad_months, *first}
        rebuild("agg_growth_daily", lambda s, a: aggregates.agg_growth_daily(s, a, *lookups, p), with_first, *both)
        rebuild("agg_campaign_performance", lambda s, a: aggregates.agg_campaign_performance(s, a, *lookups, p), with_first, *both)
        rebuild("agg_channel_performance", lambda s, a: aggregates.agg_channel_performance(s, a, lookups[1], p), {*sales_months, *ad_months}, *both)
        rebuild("agg_channel_funnel_daily", lambda a: aggregates.agg_channel_funnel_daily(a, lookups[1], p), ad_months, "fact_marketing")
        rebuild("agg_customer_segment", lambda s: aggregates.agg_customer_segment(s, customers, p), {*sales_months, *status}, "fact_sales")
        rebuild(
            "agg_sales_daily",
            lambda s: aggregates.agg_sales_daily(s, customers, m.lookup("dim_products"), *lookups[1:], p),
            sales_months,
            "fact_sales",
        )
        self._cohorts(change, moved)
        change.commit()
        return {t: (len(change.rewritten.get(t, [])), len(change.parts(t))) for t in TABLES}

    # --- the closure

    def _customers(self, change: Change, lines: DataFrame) -> DataFrame:
        """Bring history and customers up to date. Returns (customer_key, month, cohort, old_cohort, first_moved,
        status_moved): every month in which a touched customer buys now; one row with a NULL month if in none."""
        touched = change.scratch(
            "touched",
            lines.select(F.explode(F.array(f"{NEW}.customer_id", f"{OLD}.customer_id")).alias("customer_id"))
            .filter("customer_id IS NOT NULL")
            .distinct(),
        )
        by_customer = bucket("customer_id", self.buckets)
        hit = distinct_texts(touched, by_customer)
        orders = lines.select(F.col(f"{NEW}.order_id").alias("_order")).distinct()
        # all lines of an order are in one bucket of the staging table
        staged = change.read("stg_sales", self._schema("stg_sales"), distinct_texts(orders, bucket("_order", self.buckets)))
        ordered = staged.filter("customer_id IS NOT NULL").join(orders, staged.order_id.eqNullSafe(orders["_order"]), "left_semi")
        summed = ordered.groupBy("customer_id", "order_id", "order_date").agg(
            F.sum(F.when(F.col("refund_status") != "refunded", F.col("revenue"))).cast("decimal(38,9)").alias("revenue")
        )
        kept = self._read(change, "purchases", hit)
        kept = kept.join(orders, kept.order_id.eqNullSafe(orders["_order"]), "left_anti")
        history = change.scratch("purchases", kept.unionByName(summed.filter(by_customer.isin(hit))))
        change.replace("purchases", history, by_customer, hit)

        before = self._read(change, "dim_customers", hit)
        per_customer = history.groupBy("customer_id").agg(
            F.min("order_date").alias("first_purchase_date"),
            F.max("order_date").alias("latest_purchase_date"),
            F.count_distinct("order_id").alias("lifetime_orders"),
            F.sum("revenue").cast("decimal(38,9)").alias("lifetime_revenue"),
        )
        if not change.parts("dim_customers"):  # customers who never bought belong to the first build
            hit = [str(i) for i in range(self.buckets)]
        known = self.mart.table("stg_customers").filter(by_customer.isin(hit))
        after = dimensions.customers_with_history(known, per_customer, self.params)
        after = change.scratch("customers", after.filter(by_customer.isin(hit)))
        change.replace("dim_customers", after, by_customer, hit)

        old = before.select("customer_id", month_of("first_purchase_date").alias("old_cohort"), F.col("first_purchase_date").alias("_first"), F.col("customer_status").alias("_status"))
        new = after.select("customer_id", "customer_key", "first_purchase_date", "customer_status")
        moved = touched.join(new, "customer_id").join(old, "customer_id", "left")
        months = history.select("customer_id", F.expr(f"trunc({resolved_date_sql('order_date', self.params)}, 'month') AS month")).distinct()
        return change.scratch(
            "moved",
            moved.join(months, "customer_id", "left").select(
                "customer_key",
                "month",
                month_of("first_purchase_date").alias("cohort"),
                "old_cohort",
                (~F.col("first_purchase_date").eqNullSafe(F.col("_first"))).alias("first_moved"),
                (~F.col("customer_status").eqNullSafe(F.col("_status"))).alias("status_moved"),
            ),
        )

    def _fact(self, change: Change, table: str, changed: DataFrame, date: str, key: Column) -> list[str]:
        """Replace the changed rows of a fact. Returns the months they leave and the months they enter."""
        day = resolved_date_sql("day", self.params)
        days = changed.select(F.explode(F.array(F.struct(F.col(f"{NEW}.{date}").alias("day")), F.when(F.col(OLD).isNotNull(), F.struct(F.col(f"{OLD}.{date}").alias("day"))))).alias("d")).filter("d IS NOT NULL").select("d.day")
        months = distinct_texts(days, month_text(F.expr(day)))
        if not months:
            return months
        rows, m = changed.select(f"{NEW}.*"), self.mart
        if table == "fact_sales":
            customers = self._read(change, "dim_customers")
            made = facts.fact_sales(rows, customers, m.lookup("dim_products"), m.lookup("dim_channels"), m.lookup("dim_campaigns"), self.params)
        else:
            made = facts.fact_marketing(rows, m.lookup("dim_channels"), m.lookup("dim_campaigns"), self.params)
        name = made.columns[0]
        stored = self._read(change, table, months)
        stored = stored.join(rows.select(key.alias(name)), name, "left_anti").select(*made.columns)
        change.replace(table, stored.unionByName(made), month_text(BY_MONTH[table]), months)
        return months

    def _cohorts(self, change: Change, moved: DataFrame) -> None:
        """Rewrite the cohorts of touched customers, and those whose window the latest month of sales cuts elsewhere."""
        latest = max(change.parts("fact_sales"), default=None)
        if latest is None:
            return
        cohort = F.explode(F.array("cohort", "old_cohort"))
        cohorts = set(distinct_texts(moved.select(cohort.alias("c")).filter("c IS NOT NULL"), month_text("c")))
        customers = self._read(change, "dim_customers")
        was = max(change.base.tables.get("fact_sales", {}), default=latest)
        last = aggregates.COHORT_MONTHS - 1
        if was != latest:
            open_then = F.add_months(month_of("first_purchase_date"), last) > F.lit(f"{min(was, latest)}-01").cast("date")
            cohorts |= set(distinct_texts(customers.filter(open_then), month_text("first_purchase_date")))
        if not cohorts:
            return
        months = {_month_after(c, i) for c in cohorts for i in range(last + 1)}
        rows = aggregates.agg_customer_cohort(
            self._read(change, "fact_sales", months),
            customers.filter(month_text("first_purchase_date").isin(sorted(cohorts))),
            self.params,
            F.lit(f"{latest}-01").cast("date"),
        )
        change.replace("agg_customer_cohort", rows, month_text("cohort_month"), cohorts)

    # --- reading

    def _read(self, change: Change, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        return change.read(table, self._schema(table), parts)

    def _schema(self, table: str):
        if table == "stg_sales":
            return SALES.typed(self.mart.raw["raw_sales"]).schema
        if table == "stg_marketing":
            return MARKETING.typed(self.mart.raw["raw_marketing"]).schema
        if table == "purchases":
            kinds = self.mart.table("stg_sales").schema
            return kinds.__class__([*[kinds[c] for c in ("customer_id", "order_id", "order_date", "revenue")]])
        return self.mart.table(table).schema


def _month_after(month: str, more: int) -> str:
    index = int(month[:4]) * 12 + int(month[5:]) - 1 + more
    return f"{index // 12:04d}-{index % 12 + 1:02d}"
