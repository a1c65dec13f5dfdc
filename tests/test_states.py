"""Mergeable states against the facts they were made from."""

from __future__ import annotations

import random

from frames import PARAMS, mart, sale
from pyspark.sql import functions as F

from starmart.operators import states
from starmart.plans import queries
from starmart.plans.queries import _written


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def facts(spark, lines: int = 300):
    draw = random.Random(lines)
    sold = [
        sale(draw.choice([f"O{i // 3}", None]), f"P{i}", f"C{draw.choice([1, 1, 1, draw.randrange(40)])}", f"202{draw.randrange(0, 5)}-{draw.randrange(1, 13):02d}-11",
             channel=draw.choice(["Email", "Web", None]), campaign_id=draw.choice(["K1", "K2", None]))
        for i in range(lines)
    ]
    customers = [{"customer_id": f"C{i}", "region": random.Random(i).choice(["North", "South", None]), "age": 30} for i in range(1, 38)]
    return mart(spark, sales=sold, customers=customers)


def test_dense_numbers(spark, folder):
    values = spark.range(5000).selectExpr("'v' || id AS value", "date_add(DATE'2024-01-01', int(id % 90)) AS date_key").repartition(7)
    seen = _written(states.first_seen(values, "value"), folder)
    rows = states.numbered(seen, start=10).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(10, 5010))
    assert [r["since"] for r in rows] == sorted(r["since"] for r in rows)


def test_rolled_up_counts_without_the_facts(spark, folder):
    """Two batches of days, the second with values of its own: every roll-up equals the distinct counts of the facts."""
    fact = facts(spark)["fact_sales"].cache()
    batches = [fact.filter("date_key < '2022-06-01'"), fact.filter("date_key >= '2022-06-01'")]
    levels = {"channel": ["channel_key"], "year_campaign": ["year", "campaign_key"], "all": []}
    for column in ("customer_key", "order_id"):
        known, parts = None, []
        for i, batch in enumerate(batches):
            fresh = states.first_seen(batch, column) if known is None else states.new_values(batch, column, known)
            start = 0 if known is None else known.count()
            fresh = states.numbered(_written(fresh, f"{folder}/{column}-{i}"), start)
            known = fresh if known is None else known.unionByName(fresh)
            parts.append(_written(states.distinct_state(batch, column, known), f"{folder}/{column}-state-{i}"))
        ids = [r["id"] for r in known.collect()]
        assert sorted(ids) == list(range(fact.select(column).dropna().distinct().count()))
        rolled = states.rolled_up(parts[0].unionByName(parts[1]).withColumn("year", F.year("date_key")), levels, "n")
        assert all("-state-" in f for f in rolled.inputFiles())
        year = fact.withColumn("year", F.year("date_key"))
        want = {
            "channel": year.groupBy("channel_key"),
            "year_campaign": year.groupBy("year", "campaign_key"),
            "all": year.groupBy(),
        }
        for level, grouped in want.items():
            got = rolled.filter(F.col("level") == level).select(*levels[level], "n")
            assert rows_of(got) == rows_of(grouped.agg(F.count_distinct(column).alias("n")))


def test_cohorts_from_merged_activity(spark, folder):
    """Months united one by one; sales outside the calendar, cohorts before it, customers without a region."""
    m = facts(spark)
    fact, state = m["fact_sales"], None
    for year in (2020, 2021, 2022, 2023, 2024):
        part = _written(states.activity_state(fact.filter(F.year("date_key") == year), PARAMS), f"{folder}/{year}")
        state = part if state is None else _written(states.merged_activity(state, part, PARAMS), f"{folder}/to-{year}")
    got = states.cohorts_of_activity(state, m["dim_customers"], PARAMS)
    assert got.columns == m["agg_customer_cohort"].columns
    assert rows_of(got) == rows_of(m["agg_customer_cohort"])


def test_activity_before_and_after_the_calendar(spark):
    m = mart(spark, sales=[sale(date="2019-12-15"), sale("O2", date="2020-02-01"), sale("O3", date="2035-12-31"), sale("O4", customer="C2", date="2040-01-01")])
    got = states.cohorts_of_activity(states.activity_state(m["fact_sales"], PARAMS), m["dim_customers"], PARAMS)
    assert rows_of(got) == rows_of(m["agg_customer_cohort"])


def test_one_shuffle_by_customer(spark):
    state = states.activity_state(facts(spark)["fact_sales"].sparkSession.createDataFrame([], facts(spark)["fact_sales"].schema), PARAMS)
    text = state._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(customer_key") == 1 and text.count("Exchange") == 1


def test_bitmaps_are_made_after_the_last_shuffle(spark):
    """A task's own bitmap of a day, channel, campaign and block would hold a few numbers in 4 KB."""
    facts = spark.sql("SELECT date_add(date'2024-01-01', int(id % 2)) AS date_key, 'e' || id % 2 AS channel_key, 'k' || id % 2 AS campaign_key, string(id % 7) AS customer_key FROM range(100)")
    dictionary = spark.sql("SELECT string(id) AS value, 40000 * id AS id FROM range(6)")
    state = states.distinct_state(facts, "customer_key", dictionary)
    rows = [bytes(r["bits"]) for r in state.collect()]
    assert len(rows) == 12 and all(sum(b.bit_count() for b in bits) == 1 for bits in rows)
    text = state._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.rindex("bitmap_construct_agg") < text.index("Exchange")


def test_activity_and_roll_ups_read_the_raw_lines_once(spark, monkeypatch):
    """Later jobs start from what the first one wrote."""
    for name in ("cohort_activity", "rollup_distinct"):
        plans, write = [], queries._written
        monkeypatch.setattr(queries, "_written", lambda rows, path: (plans.append(rows), write(rows, path))[1])
        plans.append(queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
        monkeypatch.undo()
        raw = [p for p in plans if "l_orderkey" in p._jdf.queryExecution().optimizedPlan().toString()]
        assert len(raw) == 1, name
