"""Mergeable states: exact distinct counts and customer activity that roll up without reading the facts again.

Distinct counts. A dictionary gives every customer and order a dense number; a state row holds, for one day, channel and
campaign and one block of 32,768 numbers, the bitmap of those that occur. Bitmaps of any days, channels or campaigns are
united by ``bitmap_or_agg``, so every roll-up is exact, which sums of distinct counts are not. Numbers follow the first
day on which a customer or order is seen: what sells together in time shares blocks, and a day has few of them.

Activity. A row per customer holds the months with sales as bits, 62 to a word. States of any months are united by
``bit_or``; the twelve months of a cohort are cut out of the words when the cohort table is made.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import month_of, percent_half_up
from starmart.functions.audit import with_loaded_at
from starmart.operators.aggregates import COHORT_MONTHS
from starmart.params import MartParams

KEYS = ["date_key", "channel_key", "campaign_key"]
WORD_BITS = 62

# --- dictionaries


def first_seen(facts: DataFrame, column: str) -> DataFrame:
    """(value, since) of every value but NULL, in the order of the day it is first seen; write it, then ``numbered``."""
    seen = facts.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.min("date_key").alias("since"))
    return seen.repartitionByRange("since", "value").sortWithinPartitions("since", "value").withColumn("at", F.monotonically_increasing_id())


def numbered(written: DataFrame, start: int = 0) -> DataFrame:
    """``written`` with dense ids from ``start`` in place of ``at``, its monotonically increasing id, as read back.

    ``at`` holds the partition in its upper bits and the place in it below; only the partitions' sizes meet.
    """
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = written.groupBy(part.alias("_part")).agg((F.max(place) + 1).alias("size"))
    # one entry per partition
    ends = sizes.agg(F.sort_array(F.collect_list(F.struct("_part", "size"))).alias("ends")).select(F.explode("ends").alias("p"), "ends")
    earlier = F.filter("ends", lambda e: e["_part"] < F.col("p._part"))
    offsets = ends.select("p._part", F.aggregate(earlier, F.lit(0).cast("long"), lambda n, e: n + e["size"]).alias("_offset"))
    placed = written.withColumns({"_part": part, "_place": place}).join(offsets, "_part")
    return placed.withColumn("id", F.col("_offset") + F.col("_place") + start).drop("at", "_part", "_place", "_offset")


def new_values(facts: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """``first_seen`` of what the dictionary lacks: it gets the next numbers, known values keep theirs."""
    fresh = facts.join(dictionary.select(F.col("value").alias(column)), column, "left_anti")
    return first_seen(fresh, column)


# --- distinct counts


def distinct_state(facts: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """(date_key, channel_key, campaign_key, block, bits): the state of one batch or one set of days."""
    pairs = facts.filter(F.col(column).isNotNull()).select(*KEYS, F.col(column).alias("value"))
    numbers = pairs.join(dictionary.select("value", "id"), "value").withColumn("block", F.bitmap_bucket_number("id"))
    # numbers move, not the tasks' bitmaps of 4 KB, most of which would hold a few numbers
    gathered = numbers.select(*KEYS, "block", F.bitmap_bit_position("id").alias("place")).repartition(*KEYS, "block")
    return gathered.groupBy(*KEYS, "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def rolled_up(state: DataFrame, sets: dict[str, list[str]], name: str) -> DataFrame:
    """Distinct counts of several roll-ups at once: ``sets`` names each and says by which columns it groups.

    Result: level, the group columns (NULL where a level has none), and the count under ``name``.
    """
    columns = list(dict.fromkeys(c for group in sets.values() for c in group))
    united = state.groupingSets([[*group, "block"] for group in sets.values()], *columns, "block").agg(
        F.bitmap_or_agg("bits").alias("bits"), *[F.grouping(c).alias(f"no_{c}") for c in columns]
    )
    levels = [
        F.when(reduce(and_, [F.col(f"no_{c}") == int(c not in group) for c in columns]), level) for level, group in sets.items()
    ]
    return united.groupBy(F.coalesce(*levels).alias("level"), *columns).agg(F.sum(F.bitmap_count("bits")).alias(name))


# --- activity


def month_index(day: str | Column, start: dt.date) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) - start.year) * 12 + F.month(day) - start.month


def words_of_calendar(params: MartParams) -> int:
    start, end = params.calendar_start, params.calendar_end
    return ((end.year - start.year) * 12 + end.month - start.month) // WORD_BITS + 1


def activity_state(facts: DataFrame, params: MartParams) -> DataFrame:
    """(customer_key, words): the calendar months in which a customer bought, as bits. One shuffle, by customer."""
    index = month_index("date_key", params.calendar_start)

    def word(number: int) -> Column:
        place = index - number * WORD_BITS
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        return F.coalesce(F.bit_or(F.when(place.between(0, WORD_BITS - 1), bit)), F.lit(0).cast("long"))

    return facts.groupBy("customer_key").agg(F.array(*map(word, range(words_of_calendar(params)))).alias("words"))


def merged_activity(one: DataFrame, other: DataFrame, params: MartParams) -> DataFrame:
    """The union of two states, over any sets of months."""
    words = [F.bit_or(F.get("words", F.lit(i))) for i in range(words_of_calendar(params))]
    return one.unionByName(other).groupBy("customer_key").agg(F.array(*words).alias("words"))


def latest_month(state: DataFrame, params: MartParams) -> Column:
    """The last month in which anybody bought, as a scalar subquery over the state."""
    bits = F.size("words") * WORD_BITS - 1
    last = F.array_max(F.filter(F.sequence(F.lit(0), bits), lambda i: _bit(F.col("words"), i) == 1))
    return state.agg(F.add_months(F.lit(params.calendar_start.replace(day=1)), F.max(last))).scalar()


def _bit(words: Column, index: Column) -> Column:
    word = F.get(words, F.floor(index / WORD_BITS).cast("int"))
    return F.coalesce(F.call_function("shiftright", word, F.pmod(index, F.lit(WORD_BITS)).cast("int")).bitwiseAND(F.lit(1)), F.lit(0))


def cohorts_of_activity(state: DataFrame, customers: DataFrame, params: MartParams) -> DataFrame:
    """The cohort table from activity states: rows as in ``aggregates.agg_customer_cohort``.

    Customers meet their state once, each with the twelve bits of its cohort; a cohort's months are unfolded after the
    sums. A cohort without a region is listed with no activity.
    """
    members = (
        customers.filter(F.col("first_purchase_date").isNotNull())
        .select("customer_key", "region", month_of("first_purchase_date").alias("cohort_month"))
        .distinct()
    )
    start = month_index("cohort_month", params.calendar_start)
    active = [
        F.sum(F.when(F.col("region").isNotNull() & (start + i >= 0), _bit(F.col("words"), start + i)).otherwise(0)).alias(f"m{i}")
        for i in range(COHORT_MONTHS)
    ]
    sums = members.join(state, "customer_key", "left").groupBy("cohort_month", "region").agg(F.count("*").alias("cohort_size"), *active)
    unfolded = sums.select("cohort_month", "region", "cohort_size", F.posexplode(F.array(*[f"m{i}" for i in range(COHORT_MONTHS)])).alias("later", "active_customers"))
    table = unfolded.withColumn("activity_month", F.add_months("cohort_month", F.col("later"))).filter(F.col("activity_month") <= latest_month(state, params))
    return with_loaded_at(
        table.select(
            "cohort_month",
            "activity_month",
            F.col("later").cast("bigint").alias("months_since_acquisition"),
            "region",
            "cohort_size",
            "active_customers",
            percent_half_up("active_customers", "cohort_size").alias("retention_rate"),
        ),
        params,
    )
