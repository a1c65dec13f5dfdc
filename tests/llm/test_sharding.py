"""The hash tree: proportions, movement on growth, slots."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from starmart.llm import sharding
from starmart.llm.sharding import TreeParams


def placed(spark, n, shards, params=TreeParams()):
    rows = spark.range(n).select("id", sharding.shard_of(F.col("id"), shards, params).alias("s"))
    return {r["id"]: r["s"] for r in rows.collect()}


def test_a_new_shard_takes_rows_only_into_itself(spark):
    for shards in (1, 7, 8, 40, 41):
        before, after = placed(spark, 3000, shards), placed(spark, 3000, shards + 1)
        moved = [i for i in before if before[i] != after[i]]
        assert all(after[i] == shards for i in moved)
        assert abs(len(moved) - 3000 / (shards + 1)) < 6 * (3000 / (shards + 1)) ** 0.5 + 1


def test_weights_set_the_shares_and_changes_stay_in_their_subtree(spark):
    n, weights = 20000, (1.0, 2.0, 4.0, 1.0, 1.0, 1.0, 1.0, 1.0, 3.0)
    before = placed(spark, n, 9, TreeParams(weights=weights))
    counts = Counter(before.values())
    for s, w in enumerate(weights):
        assert abs(counts[s] - n * w / sum(weights)) < 6 * (n * w / sum(weights)) ** 0.5
    after = placed(spark, n, 9, TreeParams(weights=(1.0, 2.0, 8.0, *weights[3:])))
    assert all(after[i] == 2 for i in before if before[i] != after[i])
    lighter = placed(spark, n, 9, TreeParams(weights=(1.0, 2.0, 2.0, *weights[3:])))
    assert all(before[i] == 2 for i in before if before[i] != lighter[i])


def test_descent_equals_the_least_draw_of_all(spark):
    params = TreeParams(shards=13, shards_per_rack=3, racks_per_region=2)
    draws = F.array(*[sharding._draw(F.col("id"), F.lit(s), F.lit(1.0)) for s in range(13)])
    rows = spark.range(500).select(sharding.shard_of(F.col("id"), 13, params).alias("s"), (F.array_position(draws, F.array_min(draws)) - 1).alias("w"))
    assert all(r["s"] == r["w"] for r in rows.collect())


def test_rows_slots_and_odd_values(spark, documents):
    rows = [(i, "t" * i) for i in range(500)] + [(None, None)] * 7 + [(3, "ttt")] * 5 + [(900, "é")]
    got = sharding.assign(documents(rows, extra=True).repartition(5)).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert 0 <= r["shard"] < 40 and (r["grown_shard"] in (r["shard"], 40)) and r["law"] == "key"
        assert (r["region"], r["rack"]) == (r["shard"] // 8, r["shard"] // 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    one = next(r for r in got if r["doc_id"] == 900)
    assert (one["size"], one["text_crc32"]) == (18, zlib.crc32("é".encode()))
    null = [r for r in got if r["doc_id"] is None]
    assert {(r["size"], r["text_crc32"]) for r in null} == {(16, 0)} and len({r["shard"] for r in null}) == 1
    assert sharding.assign(documents([])).collect() == []
