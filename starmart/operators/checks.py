"""Data checks: each yields the violating rows, and a report counts them per rule."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import key_bytes

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class RowCheck:
    """A condition on single rows; ``fails`` is true on a violating row, NULL passes."""

    kind: str
    table: str
    target: str
    fails: Callable[[], Column]

    def violations(self, tables: Tables) -> DataFrame:
        return tables[self.table].filter(self.fails())


@dataclass(frozen=True)
class UniqueCheck:
    """No two rows share the columns' values; for a single column NULL is not a value."""

    kind: str
    table: str
    columns: tuple[str, ...]

    @property
    def target(self) -> str:
        return ",".join(self.columns)

    def violations(self, tables: Tables) -> DataFrame:
        rows = tables[self.table].select(*self.columns)
        if len(self.columns) == 1:
            rows = rows.filter(F.col(self.columns[0]).isNotNull())
        return rows.groupBy(*self.columns).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


@dataclass(frozen=True)
class RelationshipCheck:
    """Every non-NULL key has a row in the parent table.

    Keys are counted before the anti join, so a key that a third of the rows share is one row in it.
    """

    kind: str
    table: str
    target: str
    parent: str

    def violations(self, tables: Tables) -> DataFrame:
        keys = tables[self.table].filter(F.col(self.target).isNotNull()).groupBy(self.target)
        parents = tables[self.parent].select(self.target)
        return keys.agg(F.count("*").alias("row_count")).join(parents, self.target, "left_anti")


@dataclass(frozen=True)
class RowCountCheck:
    """Both tables have the same number of rows; a violation is one row with the difference."""

    kind: str
    table: str
    target: str

    def violations(self, tables: Tables) -> DataFrame:
        mine = tables[self.table].select(F.lit(1).cast("bigint").alias("side"))
        other = tables[self.target].select(F.lit(-1).cast("bigint").alias("side"))
        difference = mine.unionByName(other).agg(F.coalesce(F.sum("side"), F.lit(0)).alias("row_count"))
        return difference.withColumn("row_count", F.abs("row_count")).filter(F.col("row_count") != 0)


Check = RowCheck | UniqueCheck | RelationshipCheck | RowCountCheck

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"
RELATIONSHIPS, COMBINATION, EXPRESSION, ROWCOUNT = (
    "relationships",
    "unique_combination",
    "expression",
    "equal_rowcount",
)


def not_null(table: str, column: str) -> RowCheck:
    return RowCheck(NOT_NULL, table, column, lambda: F.col(column).isNull())


def accepted_values(table: str, column: str, *values: str) -> RowCheck:
    return RowCheck(ACCEPTED, table, column, lambda: ~F.col(column).isin(*values))


def expression(table: str, condition: str) -> RowCheck:
    return RowCheck(EXPRESSION, table, condition, lambda: ~F.expr(condition))


def _columns(**columns: str) -> list[tuple[str, str]]:
    return [(table, column) for table, names in columns.items() for column in names.split()]


# The checked columns, accepted values, parent tables and conditions.
CHECKS: tuple[Check, ...] = (
    *[
        not_null(table, column)
        for table, column in _columns(
            stg_customers="customer_id",
            stg_products="product_id",
            stg_campaigns="campaign_id",
            stg_channels="channel_name",
            stg_sales="order_id product_id quantity refund_status",
            stg_marketing="ads_id ad_spend",
            dim_customers="customer_key customer_id",
            dim_products="product_key product_id",
            dim_campaigns="campaign_key campaign_id",
            dim_channels="channel_key channel_name",
            dim_date="date_key",
            fact_sales="sales_key date_key customer_key product_key channel_key campaign_key net_sales",
            fact_marketing="marketing_key date_key campaign_key channel_key ad_spend",
        )
    ],
    *[
        UniqueCheck(UNIQUE, table, (column,))
        for table, column in _columns(
            stg_customers="customer_id",
            stg_products="product_id",
            stg_campaigns="campaign_id",
            stg_channels="channel_name",
            stg_marketing="ads_id",
            dim_customers="customer_key customer_id",
            dim_products="product_key product_id",
            dim_campaigns="campaign_key campaign_id",
            dim_channels="channel_key channel_name",
            dim_date="date_key",
            fact_sales="sales_key",
            fact_marketing="marketing_key",
        )
    ],
    accepted_values("stg_sales", "refund_status", "refunded", "completed"),
    RelationshipCheck(RELATIONSHIPS, "dim_campaigns", "channel_key", "dim_channels"),
    RelationshipCheck(RELATIONSHIPS, "fact_sales", "date_key", "dim_date"),
    RelationshipCheck(RELATIONSHIPS, "fact_sales", "customer_key", "dim_customers"),
    RelationshipCheck(RELATIONSHIPS, "fact_sales", "product_key", "dim_products"),
    RelationshipCheck(RELATIONSHIPS, "fact_sales", "channel_key", "dim_channels"),
    RelationshipCheck(RELATIONSHIPS, "fact_sales", "campaign_key", "dim_campaigns"),
    RelationshipCheck(RELATIONSHIPS, "fact_marketing", "date_key", "dim_date"),
    RelationshipCheck(RELATIONSHIPS, "fact_marketing", "campaign_key", "dim_campaigns"),
    RelationshipCheck(RELATIONSHIPS, "fact_marketing", "channel_key", "dim_channels"),
    UniqueCheck(COMBINATION, "stg_sales", ("order_id", "product_id")),
    expression("fact_sales", "net_sales >= 0"),
    expression("fact_sales", "abs(gross_sales - discount_amount - net_sales) < 0.01"),
    expression("fact_marketing", "ad_spend >= 0"),
    expression("agg_customer_cohort", "retention_rate between 0 and 100"),
    RowCountCheck(ROWCOUNT, "fact_sales", "stg_sales"),
    RowCountCheck(ROWCOUNT, "fact_marketing", "stg_marketing"),
)


def checks_of(kind: str) -> list[Check]:
    return [check for check in CHECKS if check.kind == kind]


def report(checks: Iterable[Check], tables: Tables) -> DataFrame:
    """Violations per rule: check, table_name, target, violations.

    A table is read once for all its row conditions, and once for all its unique keys and relationships. Relationship
    and row-count rules count the rows behind each violation.
    """
    checks = list(checks)

    def per_table(kinds: type | tuple[type, ...], count: Callable[[str, list, Tables], DataFrame]) -> list[DataFrame]:
        own = [c for c in checks if isinstance(c, kinds)]
        return [count(t, [c for c in own if c.table == t], tables) for t in dict.fromkeys(c.table for c in own)]

    parts = per_table(RowCheck, lambda t, own, tables: _count_rows(tables[t], own))
    parts += per_table((UniqueCheck, RelationshipCheck), _audit_keys)
    for check in checks:
        if isinstance(check, RowCountCheck):
            found = F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
            parts.append(_labelled(check.violations(tables).agg(found), check))
    return reduce(DataFrame.unionByName, parts)


def _stacked(rows: DataFrame, keys: list[tuple[int, tuple[str, ...]]]) -> DataFrame:
    """(rule, key) of every row and rule; a single column that is NULL is no key, a combination with NULLs is one."""

    def entry(rule: int, columns: tuple[str, ...]) -> Column:
        key = F.array(*[F.col(c).cast("string") for c in columns])
        if len(columns) == 1:
            key = F.when(F.col(columns[0]).isNotNull(), key)
        return F.struct(F.lit(rule).alias("rule"), key.alias("key"))

    stack = F.explode(F.array(*[entry(*k) for k in keys]))
    return rows.select(stack.alias("k")).select("k.rule", "k.key").filter(F.col("key").isNotNull())


def _audit_keys(table: str, checks: list[UniqueCheck | RelationshipCheck], tables: Tables) -> DataFrame:
    """All unique and relationship rules of a table in one pass over it and one over each parent.

    Every row gives one key per rule. Keys are counted before they move, so a key that a third of the rows share is one
    row in the one join with the parents' keys.
    """
    rules = list(enumerate(checks))
    columns = [(i, c.columns if isinstance(c, UniqueCheck) else (c.target,)) for i, c in rules]
    keys = _stacked(tables[table], columns).groupBy("rule", "key").agg(F.count("*").alias("row_count"))
    parents: dict[str, list[tuple[int, tuple[str, ...]]]] = {}
    for i, c in rules:
        if isinstance(c, RelationshipCheck):
            parents.setdefault(c.parent, []).append((i, (c.target,)))
    unknown = F.lit(False)
    if parents:
        known = reduce(DataFrame.unionByName, [_stacked(tables[p], own) for p, own in parents.items()]).distinct()
        keys = keys.join(known.withColumn("known", F.lit(True)), ["rule", "key"], "left")
        unknown = F.col("known").isNull()
    related = F.col("rule").isin([i for i, c in rules if isinstance(c, RelationshipCheck)])
    wrong = F.when(related, F.when(unknown, F.col("row_count"))).otherwise((F.col("row_count") > 1).cast("bigint"))
    counted = keys.groupBy("rule").agg(F.sum(wrong).alias("violations"))
    named = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("rule"), F.lit(c.kind).alias("check"), F.lit(table).alias("table_name"), F.lit(c.target).alias("target"))
                for i, c in rules
            ]
        )
    )
    rows = tables[table].sparkSession.range(1, numPartitions=1).select(named)
    return rows.join(counted, "rule", "left").select("check", "table_name", "target", F.coalesce("violations", F.lit(0)).alias("violations"))


def _count_rows(table: DataFrame, checks: list[RowCheck]) -> DataFrame:
    counts = table.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c.kind).alias("check"),
                    F.lit(c.table).alias("table_name"),
                    F.lit(c.target).alias("target"),
                    F.count_if(c.fails()).alias("violations"),
                )
                for c in checks
            ]
        ).alias("rules")
    )
    return counts.select(F.inline("rules"))


def _labelled(counted: DataFrame, check: Check) -> DataFrame:
    return counted.select(
        F.lit(check.kind).alias("check"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.target).alias("target"),
        "violations",
    )


def kpi_rules(growth: DataFrame, segments: DataFrame, cohorts: DataFrame, acquisition: DataFrame,
              campaigns: DataFrame, sales: DataFrame) -> DataFrame:
    """The publishing rules of the measures, as violation counts per rule (same columns as ``report``).

    ``acquisition`` and ``campaigns`` are the acquisition and campaign results the measures come from. Ratios and
    shares of the published tables are held against money and orders summed from the sales fact itself, so a
    table that lost or repeats rows fails.
    """
    from starmart.operators.measures import measure

    latest_month = sales.agg(F.trunc(F.max("date_key"), "month").alias("latest")).scalar()
    by_month = ["report_month"]

    lines = sales.withColumn("report_month", F.trunc("date_key", "month"))
    money = lines.groupBy(*by_month).agg(F.sum(F.when(~F.col("is_refunded"), F.col("net_sales"))).alias("fact_revenue"))
    bought = lines.select(*by_month, key_bytes("customer_key"), "order_id").filter("order_id is not null").distinct()
    bought = bought.groupBy(*by_month).agg(F.count("*").alias("fact_orders"))

    def identity(kind: str, table: str, rows: DataFrame, value: str, per: str, facts: DataFrame, truth: str) -> DataFrame:
        published, true = F.col(value).isNotNull(), F.col(truth).cast("double")
        off = F.abs(F.col(value) * F.col(per) - true) > 0.01 + 1e-9 * F.abs(true)
        wrong = (published & (off | true.isNull())) | (~published & (F.col(per) != 0) & true.isNotNull())
        return _rule(rows.join(facts, by_month, "full_outer"), kind, table, f"{value} = {truth} / {per}", wrong)

    revenue = segments.groupBy(*by_month).agg(F.sum("total_revenue").alias("segment_revenue"))
    share_sums = revenue.join(money, by_month, "full_outer").withColumn(
        "share_sum", F.try_divide(F.col("segment_revenue").cast("double"), F.col("fact_revenue").cast("double"))
    )
    monthly = measure(growth.withColumn("report_month", F.trunc("report_date", "month")),
                      "revenue", "orders", "average_order_value", by=by_month, table="agg_growth_daily")
    spend = measure(campaigns, "campaign_revenue", "ad_spend", "return_on_ad_spend", by=by_month, table="campaign_results")
    frequency = measure(segments, "customers", "purchase_frequency", by=by_month, table="agg_customer_segment")
    cost, new = F.coalesce("acquisition_cost", F.lit(0)), F.coalesce("new_customers", F.lit(0))
    return reduce(
        DataFrame.unionByName,
        [
            _rule(acquisition, "kpi_acquisition_cost", "fact_marketing", "cost and new customers > 0",
                  (cost <= 0) | (new <= 0)),
            _rule(cohorts, "kpi_retention", "agg_customer_cohort", "month 0 is 100 %",
                  (F.col("months_since_acquisition") == 0) & (F.col("retention_rate") != 100)),
            _rule(cohorts, "kpi_retention", "agg_customer_cohort", "no month after the latest sales",
                  F.col("activity_month") > latest_month),
            identity("kpi_order_value", "agg_growth_daily", monthly, "average_order_value", "orders", money, "fact_revenue"),
            identity("kpi_ad_return", "fact_sales", spend, "return_on_ad_spend", "ad_spend", money, "fact_revenue"),
            identity("kpi_frequency", "agg_customer_segment", frequency, "purchase_frequency", "customers", bought, "fact_orders"),
            _rule(share_sums, "kpi_segment_share", "agg_customer_segment", "shares of all sales of a month sum to 1",
                  (F.abs(F.col("share_sum") - 1) > 1e-6) | (F.col("share_sum").isNull() & (F.col("fact_revenue") != 0))),
        ],
    )


def _rule(rows: DataFrame, kind: str, table: str, target: str, wrong: Column) -> DataFrame:
    counted = rows.filter(wrong).agg(F.count("*").alias("violations"))
    return counted.select(
        F.lit(kind).alias("check"), F.lit(table).alias("table_name"), F.lit(target).alias("target"), "violations"
    )
