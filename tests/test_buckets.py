"""Staging from buckets, and dimensions looked up by the ids that they do not have exactly once."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from starmart.operators import facts, staging
from starmart.plans import queries
from starmart.plans.mart import Mart
from starmart.plans.queries import PARAMS, QUERIES, _staged_in_buckets, mart
from starmart.sources.buckets import bucketed
from starmart.sources.supplied import SuppliedTables
from test_scale import FOLDER, hot, plan, settings

LOOKED_UP = (("customer_id", "dim_customers"), ("product_id", "dim_products"), ("campaign_id", "dim_campaigns"))


def rows_of(frame) -> list[str]:
    return sorted(str([r[c] for c in sorted(frame.columns)]) for r in frame.collect())


def odd_mart(spark) -> Mart:
    """Hot, missing and blank ids in the sales, lines that were loaded again, and dimensions with an id twice or NULL."""
    supplied = SuppliedTables(spark, FOLDER)
    raw = {name: supplied[name] for name in supplied}
    turn = F.pmod(F.crc32("order_id"), F.lit(11))
    sales = hot(raw["raw_sales"]).withColumns(
        {
            "order_id": F.when(turn == 1, None).when(turn == 2, " ").otherwise(F.col("order_id")),
            "customer_id": F.when(turn == 3, None).when(turn == 4, "unknown").otherwise(F.col("customer_id")),
            "product_id": F.when(turn == 5, None).otherwise(F.col("product_id")),
            "campaign_id": F.when(turn == 6, "unattributed").when(turn == 7, "K3 ").otherwise(F.col("campaign_id")),
        }
    )
    again = sales.filter(turn < 4).withColumns({"_ingested_at": F.col("_ingested_at") + F.expr("interval 1 day"), "price": F.col("price") + 1})
    raw["raw_sales"] = sales.unionByName(again).unionByName(sales.filter(turn == 8))
    for table, column, name in (("raw_customers", "customer_id", "C1"), ("raw_products", "product_id", "P2"), ("raw_campaigns", "campaign_id", "K3")):
        more = raw[table].filter(F.col(column) == name)
        for value in (name, None, "unknown"):
            raw[table] = raw[table].unionByName(more.withColumn(column, F.lit(value).cast("string")))
    return Mart(spark, raw, PARAMS)


def test_staged_buckets_hold_the_latest_copies(spark, folder):
    usual = odd_mart(spark)
    typed = staging.keyed_by_order(staging.typed_sales(usual.raw["raw_sales"]))
    staged = staging.stg_keyed_sales(bucketed(typed, folder, *staging.BUCKET))
    assert staged.columns == usual["stg_sales"].columns
    assert rows_of(staged) == rows_of(usual["stg_sales"])
    with settings(spark, aqe="false"):
        assert "Exchange" in plan(usual["stg_sales"]) and "Exchange" not in plan(staged)


def test_lines_without_an_order_are_spread_over_buckets(spark, folder):
    lines = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN '' END AS order_id", "'P' || id AS product_id")
    stored = bucketed(staging.keyed_by_order(lines), folder, *staging.BUCKET)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name().alias("f")).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 500


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_exceptions_find_what_the_dimensions_find(spark, broadcast):
    usual = odd_mart(spark)
    typed = staging.typed_sales(usual.raw["raw_sales"])
    odd = {column: facts.exceptions(typed, usual[name], column) for column, name in LOOKED_UP}
    listed = {column: {(r["id"], r["found"]) for r in rows.collect()} for column, rows in odd.items()}
    assert ("C1", True) in listed["customer_id"] and ("K3", True) in listed["campaign_id"] and ("X9", False) in listed["campaign_id"]
    with settings(spark, broadcast=broadcast):
        got = Mart(spark, usual.raw, PARAMS, odd=odd)["fact_sales"].drop("loaded_at")
        assert rows_of(got) == rows_of(usual["fact_sales"].drop("loaded_at"))


@pytest.mark.parametrize(
    "name", ["fact_sales", "agg_growth_daily", "agg_campaign_performance", "agg_sales_daily", "agg_customer_segment", "agg_customer_cohort"]
)
def test_tables_over_buckets_are_the_same(spark, folder, name):
    usual = odd_mart(spark)
    got = rows_of(_staged_in_buckets(usual, folder)[name].drop("loaded_at"))
    assert got == rows_of(usual[name].drop("loaded_at"))


def test_lines_of_the_fact_are_not_shuffled(spark, folder):
    """Customers and products are more than Spark broadcasts; the few ids that they lack are not."""
    with settings(spark, aqe="false", broadcast="2000"):
        usual = mart(spark, FOLDER)
        lean = _staged_in_buckets(usual, folder)
        assert "Exchange hashpartitioning(customer_id" in plan(usual["fact_sales"])
        text = plan(lean["fact_sales"])
    assert not re.search(r"Exchange hashpartitioning\((order_id|customer_id|product_id|campaign_id)", text)


@pytest.mark.parametrize("name", ["fact_sales", "agg_growth_daily", "agg_campaign_performance", "agg_sales_daily", "kpi_sales", "kpi_campaign_region"])
def test_queries_read_staged_buckets(spark, name):
    with settings(spark, aqe="false"):
        text = plan(QUERIES[name](spark, FOLDER))
    assert "starmart_" in text and "lineitem.parquet" not in text


@pytest.mark.parametrize("name", ["rollup_distinct", "cohort_activity", "check_kpi_rules"])
def test_jobs_share_staged_buckets(spark, monkeypatch, name):
    written, write = [], queries._written
    monkeypatch.setattr(queries, "_written", lambda rows, path: (written.append(rows.columns), write(rows, path))[1])
    QUERIES[name](spark, FOLDER)
    assert [staging.SPREAD in columns for columns in written].count(True) == 1


def test_daily_sales_are_shuffled_once_by_group(spark):
    """The lines of a group meet once; campaigns that no line names do not make the lines move."""
    with settings(spark, aqe="false"):
        text = plan(mart(spark, FOLDER)["agg_sales_daily"])
    assert len(re.findall(r"Exchange hashpartitioning\(report_date", text)) == 1


def test_campaigns_in_use(spark, folder):
    lean = _staged_in_buckets(mart(spark, FOLDER), folder)
    ids = {r["campaign_id"] for r in lean.used["dim_campaigns"].collect()}
    named = {r["campaign_id"] for r in lean["stg_sales"].select("campaign_id").distinct().collect()} - {None}
    known = {r["campaign_id"] for r in lean["dim_campaigns"].collect()}
    assert ids == (named & known) | {"unknown", "unattributed"} and len(ids) < len(known) + 1


def test_sums_move_with_the_orders_only(spark):
    with settings(spark, aqe="false"):
        text = plan(mart(spark, FOLDER)["agg_growth_daily"])
    assert re.search(r"partial_sum\(CASE WHEN .*spark_grouping_id", text)


def test_customer_months_move_half_size_keys(spark):
    with settings(spark, aqe="false", broadcast="-1"):
        for name in ("agg_customer_segment", "agg_customer_cohort"):
            assert "unhex(" in plan(mart(spark, FOLDER)[name])
