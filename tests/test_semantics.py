"""Exact semantics on hand-made rows, one test per fact."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from frames import CUSTOMERS, PARAMS, ad, day, dicts, mart, sale
from pyspark.sql import functions as F

from starmart.functions import surrogate_key
from starmart.operators import checks, measures


def rows_by(frame, *keys):
    return {tuple(r[k] for k in keys): r for r in dicts(frame)}


def test_spend_repeats_on_every_region_that_sold(spark):
    m = mart(spark, sales=[sale(), sale("O2", customer="C2")], marketing=[ad()])
    growth = rows_by(m["agg_growth_daily"], "region")
    assert {k: r["total_ad_spend"] for k, r in growth.items()} == {("north",): 5, ("south",): 5}
    campaign = rows_by(m["agg_campaign_performance"], "region")
    assert {r["total_ad_spend"] for r in campaign.values()} == {5}
    results = measures.campaign_results(m["fact_sales"], m["fact_marketing"])
    assert [r["total_ad_spend"] for r in dicts(results)] == [5]


def test_refunds_by_table(spark):
    sold = [sale(), sale("O2", refund_status="Refunded"), sale("O3", refund_status=None)]
    m = mart(spark, sales=sold)
    daily, month = dicts(m["agg_growth_daily"])[0], dicts(m["agg_channel_performance"])[0]
    assert (daily["total_revenue"], daily["total_orders"]) == (20, 3)
    assert (month["total_revenue"], month["total_orders"]) == (60, 3)
    customer = rows_by(m["dim_customers"], "customer_id")[("C1",)]
    assert (customer["lifetime_orders"], customer["lifetime_revenue"]) == (3, 20)
    flags = {r["order_id"]: r["is_refunded"] for r in dicts(m["fact_sales"])}
    assert flags == {"O1": False, "O2": True, "O3": None}


def test_only_refunds_is_zero_in_daily_and_null_in_segments(spark):
    m = mart(spark, sales=[sale(refund_status="refunded")])
    assert dicts(m["agg_growth_daily"])[0]["total_revenue"] == 0
    assert dicts(m["agg_customer_segment"])[0]["total_revenue"] is None


def test_spend_without_sales(spark):
    m = mart(spark, sales=[sale()], marketing=[ad(channel_name="Web")])
    growth = rows_by(m["agg_growth_daily"], "channel_name")
    assert (growth[("web",)]["total_ad_spend"], growth[("web",)]["region"]) == (5, "unknown")
    assert {r["channel_name"] for r in dicts(m["agg_channel_performance"])} == {"email"}


def test_unknown_customer_is_neither_new_nor_returning(spark):
    row = dicts(mart(spark, sales=[sale(customer="nobody")])["agg_growth_daily"])[0]
    assert (row["total_customers"], row["new_customers"], row["returning_customers"]) == (1, 0, 0)
    assert row["region"] == "unknown"


@pytest.mark.parametrize(
    "age,band",
    [(None, "55+"), (17, "Under 18"), (18, "18-24"), (24, "18-24"), (25, "25-34"), (54, "45-54"), (55, "55+")],
)
def test_age_band(spark, age, band):
    m = mart(spark, customers=[{"customer_id": "C1", "age": age}])
    assert rows_by(m["dim_customers"], "customer_id")[("C1",)]["age_band"] == band


def test_prospects_have_no_history(spark):
    customers = rows_by(mart(spark, sales=[sale()])["dim_customers"], "customer_id")
    assert customers[("C1",)]["customer_status"] == "new"
    prospect = customers[("C2",)]
    assert (prospect["customer_status"], prospect["lifetime_orders"], prospect["lifetime_revenue"]) == (
        "prospect", None, None,
    )
    assert customers[("unknown",)]["lifetime_orders"] == 0


def test_dates_outside_the_calendar(spark):
    m = mart(spark, sales=[sale(date="2019-12-31"), sale("O2", date="2020-01-05"), sale("O3", date=None)])
    assert sorted(r["date_key"] for r in dicts(m["fact_sales"])) == [
        day("1900-01-01"), day("1900-01-01"), day("2020-01-05"),
    ]
    assert rows_by(m["dim_customers"], "customer_id")[("C1",)]["first_purchase_date"] == day("2019-12-31")
    cohort = rows_by(m["agg_customer_cohort"], "months_since_acquisition")
    assert (cohort[(0,)]["cohort_month"], cohort[(0,)]["active_customers"]) == (day("2019-12-01"), 0)
    assert cohort[(1,)]["retention_rate"] == 100


def test_calendar_edges(spark):
    days = rows_by(mart(spark)["dim_date"], "date_key")
    assert len(days) == 5845 and max(days) == (day("2035-12-31"),) and min(days) == (day("1900-01-01"),)
    assert days[(day("2021-01-01"),)]["year_week"] == "2021-W53"
    leap = days[(day("2024-02-29"),)]
    assert (leap["month_end_date"], leap["quarter_end_date"], leap["year_end_date"]) == (
        day("2024-02-29"), day("2024-03-31"), day("2024-12-31"),
    )
    assert (leap["day_of_week"], leap["week_start_date"], leap["week_end_date"]) == (
        5, day("2024-02-26"), day("2024-03-03"),
    )
    assert days[(day("2024-06-15"),)]["is_today"] and days[(day("2024-06-14"),)]["is_yesterday"]
    assert days[(day("2024-06-15"),)]["is_weekend"] and not leap["is_weekend"]


def test_cohort_window(spark):
    customers = [{"customer_id": "C1", "region": "North"}, {"customer_id": "C2"}, {"customer_id": "C3", "region": "N2"}]
    sold = [
        sale(date="2022-11-20"),
        sale("O2", date="2023-10-02"),
        sale("O3", date="2023-11-02"),
        sale("O4", customer="C2", date="2022-11-05"),
        sale("O5", customer="C3", date="2023-12-05"),
    ]
    cohorts = dicts(mart(spark, customers=customers, sales=sold)["agg_customer_cohort"])
    north = {r["months_since_acquisition"]: r for r in cohorts if r["region"] == "north"}
    assert sorted(north) == list(range(12))
    assert [i for i, r in sorted(north.items()) if r["active_customers"]] == [0, 11]
    assert north[11]["activity_month"] == day("2023-10-01")
    # No region: counted in the size, never matched as active.
    nowhere = [r for r in cohorts if r["region"] is None]
    assert {(r["cohort_size"], r["active_customers"], r["retention_rate"]) for r in nowhere} == {(1, 0, 0.0)}
    # A cohort of the latest month has that month only.
    assert [r["months_since_acquisition"] for r in cohorts if r["region"] == "n2"] == [0]
    order = [(r["cohort_month"], r["region"] or "", r["months_since_acquisition"]) for r in cohorts]
    assert order == sorted(order)


def test_retention_rounds_half_up(spark):
    customers = [{"customer_id": f"C{i}", "region": "r"} for i in range(8)]
    sold = [sale(f"O{i}", customer=f"C{i}") for i in range(8)] + [sale("P9", customer="C0", date="2024-02-01")]
    cohorts = rows_by(mart(spark, customers=customers, sales=sold)["agg_customer_cohort"], "months_since_acquisition")
    assert cohorts[(1,)]["retention_rate"] == 12.5
    thirds = [sale(f"O{i}", customer=f"C{i}") for i in range(3)] + [
        sale(f"P{i}", customer=f"C{i}", date="2024-02-01") for i in range(2)
    ]
    cohorts = rows_by(mart(spark, customers=customers, sales=thirds)["agg_customer_cohort"], "months_since_acquisition")
    assert cohorts[(1,)]["retention_rate"] == 66.67


def test_missing_channels_and_campaigns(spark):
    sold = [
        sale("O1", channel=" \t ", campaign_id=None),
        sale("O2", channel=None, campaign_id=" "),
        sale("O3", channel="Fax", campaign_id="K404"),
        sale("O4", channel=" EMAIL\n", campaign_id="K1 "),
    ]
    m = mart(spark, sales=sold, marketing=[ad("A1", campaign_id=None, channel_name=None), ad("A2", channel_name="")])
    names = {r["channel_key"]: r["channel_name"] for r in dicts(m["dim_channels"])}
    ids = {r["campaign_key"]: r["campaign_id"] for r in dicts(m["dim_campaigns"])}
    fact = {r["order_id"]: (names[r["channel_key"]], ids[r["campaign_key"]]) for r in dicts(m["fact_sales"])}
    assert fact == {
        "O1": ("unattributed", "unattributed"),
        "O2": ("unattributed", "unattributed"),
        "O3": ("unknown", "unknown"),
        "O4": ("email", "K1"),
    }
    ads = {r["ads_id"]: (names[r["channel_key"]], ids[r["campaign_key"]]) for r in dicts(m["fact_marketing"])}
    assert ads == {"A1": ("unknown", "unknown"), "A2": ("unknown", "K1")}


def test_orders_of_a_finer_table_do_not_add_up(spark):
    campaigns = [{"campaign_id": "K1"}, {"campaign_id": "K2"}]
    m = mart(spark, campaigns=campaigns, sales=[sale(), sale(product="P2", campaign_id="K2")])
    assert measures.measure(m["agg_growth_daily"], "orders", table="agg_growth_daily").first()[0] == 2
    assert dicts(measures.monthly_sales(m["fact_sales"]))[0]["total_orders"] == 1


def test_duplicate_dimension_rows_are_reported(spark):
    m = mart(spark, customers=[*CUSTOMERS, CUSTOMERS[0]], sales=[sale()])
    found = {(r["table_name"], r["target"]): r["violations"] for r in dicts(checks.report(checks.checks_of("unique"), m))}
    assert found[("stg_customers", "customer_id")] == 1
    assert found[("dim_customers", "customer_key")] == 1
    assert found[("dim_products", "product_key")] == 0
    assert m["fact_sales"].count() == 2
    rowcounts = {r["target"]: r["violations"] for r in dicts(checks.report(checks.checks_of("equal_rowcount"), m))}
    assert rowcounts == {"stg_sales": 1, "stg_marketing": 0}
    # The doubled customer is still one customer, and its doubled lines stay doubled in the money.
    segment = dicts(m["agg_customer_segment"])[0]
    assert (segment["total_customers"], segment["total_orders"], segment["total_revenue"]) == (1, 1, 80)


def test_latest_copy(spark):
    later = dt.datetime(2024, 6, 2)
    sold = [
        sale(quantity=1),
        sale(quantity=9, _ingested_at=later),
        sale(product="P2", quantity=4),
        sale(order=None, product="P3", customer="first"),
        sale(order=None, product="P3", customer="second", _ingested_at=later),
        sale("O7", quantity=3, price=Decimal("1.00")),
        sale("O7", quantity=3, price=Decimal("2.00")),
        sale(" O1 ", quantity=5),
    ]
    staged = rows_by(mart(spark, sales=sold)["stg_sales"], "order_id", "product_id")
    assert len(staged) == 4
    assert staged[("O1", "P1")]["quantity"] == 9
    assert staged[(None, "P3")]["customer_id"] == "second"
    assert staged[("O7", "P1")]["price"] == 2
    ads = mart(spark, marketing=[ad(clicks=1), ad(clicks=2, _ingested_at=later)])
    assert [r["clicks"] for r in dicts(ads["stg_marketing"])] == [2]


def test_campaign_ids_keep_their_case(spark):
    campaigns = [{"campaign_id": "k1"}, {"campaign_id": "K1"}]
    customers = [{"customer_id": "C1", "acquisition_campaign": " K1 "}]
    m = mart(spark, campaigns=campaigns, customers=customers, sales=[sale(campaign_id="k1")])
    ids = {r["campaign_key"]: r["campaign_id"] for r in dicts(m["dim_campaigns"])}
    assert [ids[r["campaign_key"]] for r in dicts(m["fact_sales"])] == ["k1"]
    assert rows_by(m["stg_customers"], "customer_id")[("C1",)]["acquisition_campaign"] == "K1"
    assert rows_by(m["dim_customers"], "customer_id")[("C1",)]["acquisition_campaign"] == "k1"


def test_unmatched_campaign_channel_has_no_key(spark):
    campaigns = [{"campaign_id": "K1", "channel": "EMAIL "}, {"campaign_id": "K2", "channel": "Fax"}]
    m = mart(spark, campaigns=campaigns)
    table = rows_by(m["dim_campaigns"], "campaign_id")
    channels = rows_by(m["dim_channels"], "channel_name")
    assert table[("K1",)]["channel_key"] == channels[("email",)]["channel_key"]
    assert table[("K2",)]["channel_key"] is None
    assert table[("unknown",)]["channel_key"] == channels[("unknown",)]["channel_key"]
    assert table[("unattributed",)]["budget"] == 0


def test_money_columns_of_a_line(spark):
    line = sale(quantity=3, price=Decimal("10.05"), unit_cost=Decimal("6.00"), discount=Decimal("0.10"),
                revenue=Decimal("27.14"))
    row = dicts(mart(spark, sales=[line])["fact_sales"])[0]
    assert (row["gross_sales"], row["total_cost"], row["discount_amount"], row["gross_profit"], row["unit_margin"]) == (
        Decimal("30.15"), Decimal("18.00"), Decimal("3.0150"), Decimal("9.14"), Decimal("4.05"),
    )


def test_marketing_ratios(spark):
    ads = [ad("A1"), ad("A2", impressions=0, clicks=0, conversions=0)]
    fact = rows_by(mart(spark, marketing=ads)["fact_marketing"], "ads_id")
    one = fact[("A1",)]
    assert (one["click_through_rate"], one["conversion_rate"], one["cost_per_click"]) == (0.1, 0.2, 0.5)
    assert (one["cost_per_thousand_impressions"], one["cost_per_conversion"]) == (50.0, 2.5)
    two = fact[("A2",)]
    assert all(two[c] is None for c in two if c.endswith(("rate", "click", "impressions", "conversion")) and c != "impressions")


def test_key_contract(spark):
    row = spark.sql("select 'a' x, cast(null as string) y").select(surrogate_key("x", "y").alias("k")).first()
    assert row.k == spark.sql("select md5('a-_null_')").first()[0]
    keys = {
        name: {r[0] for r in mart(spark)[name].filter(f"{column} = 'unknown'").select(key).collect()}
        for name, column, key in (
            ("dim_channels", "channel_name", "channel_key"),
            ("dim_campaigns", "campaign_id", "campaign_key"),
            ("dim_products", "product_id", "product_key"),
            ("dim_customers", "customer_id", "customer_key"),
        )
    }
    assert len(set(map(frozenset, keys.values()))) == 1


def test_orders_shared_by_customers_count_once(spark):
    customers = [{"customer_id": c, "region": "r"} for c in ("C1", "C2")]
    sold = [sale(), sale(product="P2", customer="C2"), sale(order=None, customer="C2")]
    row = dicts(mart(spark, customers=customers, sales=sold)["agg_growth_daily"])[0]
    assert (row["total_orders"], row["total_customers"], row["total_revenue"]) == (1, 2, 60)


def test_new_and_returning_by_day_and_month(spark):
    m = mart(spark, sales=[sale(), sale("O2", date="2024-01-20"), sale("O3", date="2024-02-01")])
    daily = rows_by(m["agg_growth_daily"], "report_date")
    flags = {k[0].isoformat(): (r["new_customers"], r["returning_customers"]) for k, r in daily.items()}
    assert flags == {"2024-01-10": (1, 0), "2024-01-20": (0, 1), "2024-02-01": (0, 1)}
    monthly = rows_by(m["agg_campaign_performance"], "report_month")
    assert [r["new_customers"] for _, r in sorted(monthly.items())] == [1, 0]


def test_audit_column_is_last(spark):
    m = mart(spark, sales=[sale()], marketing=[ad()])
    for name in ("dim_campaigns", "dim_customers", "dim_date", "fact_sales", "fact_marketing", "agg_customer_cohort"):
        assert m[name].columns[-1] == "loaded_at"
        assert m[name].selectExpr("max(loaded_at) = timestamp'2024-06-15 00:00:00Z'").first()[0]
    assert "loaded_at" not in m["dim_channels"].columns + m["dim_products"].columns


def test_segment_counts(spark):
    sold = [sale(), sale("O2"), sale("O3", customer="C2")]
    table = rows_by(mart(spark, sales=sold)["agg_customer_segment"], "region")
    north = table[("north",)]
    assert (north["total_customers"], north["customers_with_multiple_orders_in_month"], north["total_orders"]) == (1, 1, 2)
    assert table[("south",)]["customers_with_multiple_orders_in_month"] == 0


def test_shares_sum_to_one_within_their_context(spark):
    m = mart(spark, sales=[sale(), sale("O2", customer="C2"), sale("O3", customer="C2", date="2024-02-02")])
    rows = dicts(measures.share(m["agg_customer_segment"], "total_revenue", ["report_month", "region"], ["report_month"], "s"))
    assert sorted((r["report_month"].month, r["region"], r["s"]) for r in rows) == [
        (1, "north", 0.5), (1, "south", 0.5), (2, "south", 1.0),
    ]


def test_measure_filters_before_it_sums(spark):
    m = mart(spark, sales=[sale(), sale("O2", customer="C2", revenue=Decimal("40.00"))])

    got = measures.measure(m["agg_growth_daily"], "average_order_value", "gross_margin", where=F.col("region") == "south", table="agg_growth_daily")
    assert got.first().asDict() == {"average_order_value": 40.0, "gross_margin": 0.7}


def test_params_move_the_calendar(spark):
    from dataclasses import replace

    params = replace(PARAMS, calendar_end=dt.date(2023, 12, 31))
    m = mart(spark, params, sales=[sale()])
    assert [r["date_key"] for r in dicts(m["fact_sales"])] == [day("1900-01-01")]
    assert m["dim_date"].count() == 1462


@pytest.mark.parametrize(
    ("name", "table"),
    [("ad_spend", "agg_campaign_performance"), ("return_on_ad_spend", "agg_campaign_performance"),
     ("customers", "agg_growth_daily"), ("new_customer_count", "agg_campaign_performance")],
)
def test_measures_refuse_tables_on_which_they_would_be_wrong(spark, name, table):
    """Spend that repeats per region, and distinct counts of a finer table."""
    with pytest.raises(ValueError, match="cannot be read from"):
        measures.measure(spark.range(1), name, table=table)


def test_each_publishing_rule_can_fail(spark):
    m = mart(spark, sales=[sale("O1"), sale("O2", customer="C2", date="2024-02-10")], marketing=[ad(), ad("A2", date="2024-02-10")])
    parts = {
        "growth": m["agg_growth_daily"], "segments": m["agg_customer_segment"], "cohorts": m["agg_customer_cohort"],
        "acquisition": measures.acquisition_results(m["fact_sales"], m["fact_marketing"], m["dim_customers"]),
        "campaigns": measures.campaign_results(m["fact_sales"], m["fact_marketing"]), "sales": m["fact_sales"],
    }

    def failing(**spoiled):
        rows = checks.kpi_rules(**{**parts, **spoiled}).collect()
        return {(r["check"], r["target"]) for r in rows if r["violations"]}

    assert failing() == set()
    half = lambda name, column: parts[name].withColumn(column, F.col(column) / 2)
    assert ("kpi_order_value", "average_order_value = fact_revenue / orders") in failing(growth=half("growth", "total_revenue"))
    assert ("kpi_ad_return", "return_on_ad_spend = fact_revenue / ad_spend") in failing(campaigns=half("campaigns", "total_revenue"))
    assert ("kpi_frequency", "purchase_frequency = fact_orders / customers") in failing(segments=half("segments", "total_orders"))
    assert ("kpi_segment_share", "shares of all sales of a month sum to 1") in failing(segments=parts["segments"].limit(1))
    assert {c for c, _ in failing(acquisition=parts["acquisition"].withColumn("new_customers", F.lit(0)))} == {"kpi_acquisition_cost"}
    assert ("kpi_retention", "month 0 is 100 %") in failing(cohorts=half("cohorts", "retention_rate"))
    late = parts["cohorts"].withColumn("activity_month", F.add_months("activity_month", 60))
    assert ("kpi_retention", "no month after the latest sales") in failing(cohorts=late)
