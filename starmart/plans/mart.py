"""The mart as a whole: lazily over raw tables, or built into a folder table by table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import aggregates, dimensions, facts, staging
from starmart.operators.calendar import dim_date
from starmart.params import MartParams
from starmart.sources import sinks

STAGING = ("stg_campaigns", "stg_channels", "stg_customers", "stg_products", "stg_sales", "stg_marketing")
DIMENSIONS = ("dim_channels", "dim_campaigns", "dim_customers", "dim_products", "dim_date")
FACTS = ("fact_sales", "fact_marketing")
AGGREGATES = (
    "agg_growth_daily",
    "agg_campaign_performance",
    "agg_channel_performance",
    "agg_channel_funnel_daily",
    "agg_customer_segment",
    "agg_customer_cohort",
    "agg_sales_daily",
)
TABLES = STAGING + DIMENSIONS + FACTS + AGGREGATES


class Mart:
    """Every table of the mart as a lazy DataFrame over the raw tables.

    ``built`` replaces tables by ones already written; what reads them then starts from the files.
    ``row_counts`` are the rows seen while they were written, ``odd`` the ids that the sales fact does not find exactly
    once in a dimension, if they are known (``facts.exceptions``), ``used`` the members of a dimension that sales can have,
    if they were cut out of it. Building a plan runs no job.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        params: MartParams = MartParams(),
        built: dict[str, DataFrame] | None = None,
        row_counts: Mapping[str, int] | None = None,
        odd: Mapping[str, DataFrame] | None = None,
        used: Mapping[str, DataFrame] | None = None,
    ):
        self.spark, self.raw, self.params = spark, raw, params
        self.built = dict(built or {})
        self.row_counts = dict(row_counts or {})
        self.odd, self.used = dict(odd or {}), dict(used or {})

    def table(self, name: str) -> DataFrame:
        return self.built[name] if name in self.built else getattr(self, name)

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def lookup(self, name: str) -> DataFrame:
        """A dimension as the side of a join: broadcast when it was written with few enough rows. Otherwise
        Spark decides by size, also at run time, and splits skewed keys where it shuffles."""
        rows = self.row_counts.get(name)
        small = rows is not None and rows <= self.params.broadcast_rows
        return F.broadcast(self.table(name)) if small else self.table(name)

    @cached_property
    def stg_campaigns(self) -> DataFrame:
        return staging.stg_campaigns(self.raw["raw_campaigns"])

    @cached_property
    def stg_channels(self) -> DataFrame:
        return staging.stg_channels(self.raw["raw_channels"])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["raw_customers"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["raw_products"])

    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.stg_sales(self.raw["raw_sales"])

    @cached_property
    def stg_marketing(self) -> DataFrame:
        return staging.stg_marketing(self.raw["raw_marketing"])

    @cached_property
    def dim_channels(self) -> DataFrame:
        return dimensions.dim_channels(self.table("stg_channels"))

    @cached_property
    def dim_campaigns(self) -> DataFrame:
        return dimensions.dim_campaigns(self.table("stg_campaigns"), self.lookup("dim_channels"), self.params)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.table("stg_customers"), self.table("stg_sales"), self.params)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.table("stg_products"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(self.spark, self.params)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(
            self.table("stg_sales"),
            self.lookup("dim_customers"),
            self.lookup("dim_products"),
            self.lookup("dim_channels"),
            self.lookup("dim_campaigns"),
            self.params,
            self.odd,
        )

    @cached_property
    def fact_marketing(self) -> DataFrame:
        return facts.fact_marketing(
            self.table("stg_marketing"), self.lookup("dim_channels"), self.lookup("dim_campaigns"), self.params
        )

    @cached_property
    def agg_growth_daily(self) -> DataFrame:
        return aggregates.agg_growth_daily(*self._facts_and_lookups(), self.params)

    @cached_property
    def agg_campaign_performance(self) -> DataFrame:
        return aggregates.agg_campaign_performance(*self._facts_and_lookups(), self.params)

    @cached_property
    def agg_channel_performance(self) -> DataFrame:
        return aggregates.agg_channel_performance(
            self.table("fact_sales"), self.table("fact_marketing"), self.lookup("dim_channels"), self.params
        )

    @cached_property
    def agg_channel_funnel_daily(self) -> DataFrame:
        return aggregates.agg_channel_funnel_daily(
            self.table("fact_marketing"), self.lookup("dim_channels"), self.params
        )

    @cached_property
    def agg_customer_segment(self) -> DataFrame:
        return aggregates.agg_customer_segment(self.table("fact_sales"), self.lookup("dim_customers"), self.params)

    @cached_property
    def agg_customer_cohort(self) -> DataFrame:
        return aggregates.agg_customer_cohort(self.table("fact_sales"), self.lookup("dim_customers"), self.params)

    @cached_property
    def agg_sales_daily(self) -> DataFrame:
        return aggregates.agg_sales_daily(
            self.table("fact_sales"),
            self.lookup("dim_customers"),
            self.lookup("dim_products"),
            self.lookup("dim_channels"),
            self.used.get("dim_campaigns", self.lookup("dim_campaigns")),
            self.params,
        )

    def _facts_and_lookups(self) -> tuple[DataFrame, ...]:
        return (
            self.table("fact_sales"),
            self.table("fact_marketing"),
            self.lookup("dim_customers"),
            self.lookup("dim_channels"),
            self.lookup("dim_campaigns"),
        )


def build_mart(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str, params: MartParams = MartParams()
) -> dict[str, DataFrame]:
    """Rebuild every table under ``folder`` and return them as read back.

    Each table is written before the next one reads it: nothing is computed twice, a lost executor
    costs tasks of one table only, and the files tell Spark the true sizes of the dimensions. The two
    deduplicated staging tables are written too, since several tables read them; the other staging
    tables are cheap projections and stay views.
    """
    mart = Mart(spark, raw, params)
    for name in ("stg_sales", "stg_marketing", *DIMENSIONS, *FACTS, *AGGREGATES):
        path = f"{folder}/{name}"
        table = mart.table(name)
        if name in FACTS:
            sinks.write_fact(table, path)
        else:
            mart.row_counts[name] = sinks.write_table(table, path)
        mart.built[name] = spark.read.schema(table.schema).parquet(path).select(*table.columns)
    return {name: mart.table(name) for name in TABLES}
