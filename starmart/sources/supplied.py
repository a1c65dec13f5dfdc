"""The six raw tables, derived from the supplied parquet tables (mapping in FIXTURES.md).

Every supplied row is used. Orphans, prospects, blanks and re-loaded copies come from changed ids and
values, not from dropped rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starmart.sources import schemas


# The columns of the supplied files. Declared, so that opening one runs no job.
FILES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


class SuppliedTables(Mapping):
    """Raw tables by name over one folder; a supplied file is opened when a table that needs it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        derive, files = DERIVED_FROM[name]
        return derive(*[self.spark.read.schema(FILES[file]).parquet(f"{self.folder}/{file}.parquet") for file in files])

    def __iter__(self):
        return iter(DERIVED_FROM)

    def __len__(self) -> int:
        return len(DERIVED_FROM)


def raw_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(places, customer.c_nationkey == places.n_nationkey).selectExpr(
        "CASE WHEN c_custkey % 29 = 0 THEN 'CX' ELSE 'C' END || c_custkey AS customer_id",
        "CASE WHEN c_custkey % 2 = 0 THEN ' Female ' ELSE 'MALE' END AS gender",
        "CASE WHEN c_custkey % 31 <> 0 THEN 15 + c_custkey % 60 END AS age",
        "n_name AS country",
        "CASE WHEN c_custkey % 37 <> 0 THEN r_name END AS region",
        "'City ' || c_nationkey AS city",
        "date_add(DATE'2019-01-01', int(c_custkey % 2000)) AS acquisition_date",
        "c_mktsegment AS acquisition_channel",
        "'K' || (c_custkey % 10) AS acquisition_campaign",
    )


def raw_products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "CASE WHEN p_partkey % 97 = 0 THEN 'PX' ELSE 'P' END || p_partkey AS product_id",
        "p_name AS product_name",
        f"{_money('round(p_retailprice * 100)')} AS price",
        "'size ' || (p_size % 5) AS sub_category",
        "p_type AS category",
        "' ' || p_brand || ' ' AS brand",
        "cast(NULL AS string) AS supplier_id",
        f"{_money('round(p_retailprice * 60)')} AS unit_cost",
    )


def raw_channels(region: DataFrame) -> DataFrame:
    return region.selectExpr(
        "'Channel ' || r_regionkey AS channel_name",
        "CASE WHEN r_regionkey = 2 THEN 'Organic' ELSE 'Paid' END AS channel_category",
        "'\t' || r_name || ' ' AS traffic_type",
    )


def raw_campaigns(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "'K' || s_suppkey AS campaign_id",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'Acquisition' ELSE 'Retargeting' END AS campaign_type",
        "'Channel ' || CASE WHEN s_suppkey % 4 = 3 THEN 8 ELSE s_suppkey % 4 END AS channel",
        "DATE'2024-01-01' AS start_date",
        "DATE'2024-12-31' AS end_date",
        "cast(NULL AS decimal(38,9)) AS total_revenue",
        "s_name AS campaign_name",
        f"{_money('round(s_acctbal * 100) + CASE WHEN s_suppkey % 7 = 3 THEN 1234567890150 ELSE 0 END')} AS budget",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'Acquisition' ELSE 'Retention' END AS campaign_objective",
    )


def raw_sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    # Orders grow with their lines, so this is a shuffle join at any size worth planning for.
    lines = lineitem.join(orders.hint("merge"), lineitem.l_orderkey == orders.o_orderkey).selectExpr(
        "*",
        "bigint(l_quantity) AS units",
        # some prices beyond ten digits, some discounts of three places
        "bigint(round(l_extendedprice * 100)) div bigint(l_quantity) "
        "+ CASE WHEN l_orderkey % 499 = 0 THEN 1234567890150 ELSE 0 END AS cents",
        "bigint(round(l_discount * 1000)) + CASE WHEN l_orderkey % 17 = 0 THEN 5 ELSE 0 END AS permille",
    )
    return lines.selectExpr(
        "'O' || l_orderkey AS order_id",
        "'C' || o_custkey AS customer_id",
        "o_orderstatus AS customer_status",
        "'P' || l_partkey AS product_id",
        "cast(NULL AS string) AS product_name",
        "cast(NULL AS string) AS category",
        "l_linestatus AS ship_mode",
        "units AS quantity",
        "cast(cast(permille AS decimal(6,0)) * cast(0.001 AS decimal(4,3)) AS decimal(10,9)) AS discount",
        f"{_money('cents * 6 div 10')} AS unit_cost",
        f"{_money('cents')} AS price",
        "CASE WHEN l_returnflag = 'R' THEN 'Refunded' ELSE 'Completed' END AS refund_status",
        f"{_money('units * cents * (1000 - permille) div 1000')} AS revenue",
        "add_months(date(o_orderdate), 288) AS order_date",
        """CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '' WHEN '5-LOW' THEN 'Channel 9'
           ELSE 'CHANNEL ' || (int(left(o_orderpriority, 1)) - 1) END AS channel""",
        "CASE l_suppkey % 10 WHEN 9 THEN 'X9' WHEN 8 THEN NULL ELSE 'K' || (l_suppkey % 10) END AS campaign_id",
        f"cast(l_shipdate AS timestamp_ntz) AS {schemas.INGESTED_AT}",
    )


def raw_marketing(events: DataFrame) -> DataFrame:
    # Every 50th ad record was loaded a second time a day later, one cent dearer.
    records = events.selectExpr(
        "*", "explode(CASE WHEN event_id % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    ).selectExpr("*", "bigint(round(value * 100)) + copy AS cents", "event_id % 10 AS campaign")
    return records.selectExpr(
        "'A' || event_id AS ads_id",
        "CASE WHEN campaign = 9 THEN 'X' ELSE 'K' END || campaign AS campaign_id",
        """CASE event_type WHEN 'click' THEN 'Channel 0' WHEN 'view' THEN 'channel 1 '
           WHEN 'purchase' THEN 'Channel 2' ELSE 'Channel 9' END AS channel_name""",
        "date(ts) AS date",
        f"{_money('cents')} AS ad_spend",
        "CASE WHEN event_id % 101 = 0 THEN 0 ELSE cents * 10 + 100 END AS impressions",
        "CASE WHEN event_type = 'error' THEN 0 ELSE cents % 50 END AS clicks",
        "CASE WHEN event_type = 'purchase' THEN cents % 50 div 5 ELSE 0 END AS conversions",
        "CASE WHEN campaign % 2 = 0 THEN 'Acquisition' ELSE 'Retargeting' END AS campaign_type",
        "CASE WHEN campaign % 3 = 0 THEN 'Acquisition' ELSE 'Retention' END AS campaign_objective",
        f"cast(ts AS timestamp_ntz) + make_dt_interval(copy) AS {schemas.INGESTED_AT}",
    )


def _money(cents: str) -> str:
    """Whole cents as an amount, without a double on the way."""
    return f"cast(cast({cents} AS decimal(18,0)) * cast(0.01 AS decimal(3,2)) AS decimal(38,9))"


DERIVED_FROM = {
    "raw_customers": (raw_customers, ("customer", "nation", "region")),
    "raw_products": (raw_products, ("part",)),
    "raw_channels": (raw_channels, ("region",)),
    "raw_campaigns": (raw_campaigns, ("supplier",)),
    "raw_sales": (raw_sales, ("lineitem", "orders")),
    "raw_marketing": (raw_marketing, ("events",)),
}
