"""The prefix trie against a trie of dictionaries, and against its SQL."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from starmart.llm import trie
from starmart.llm.expected import OP13

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = [*turns.get(c - c % 5, [])[:h], *own[h:]]
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        worth = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += not children[node]
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), children[node], leaves[node], saved[node], digest(ends[node]))
        for node, convs in members.items()
    )


def found(frame, params=trie.TrieParams()):
    rows = trie.prefix_trie(frame, params).select(*COLUMNS).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


def test_supplied_conversations_against_brute_force_and_sql(spark):
    frame = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    want = brute(frame.select("conv_id", "turn", "role", "text").collect())
    assert found(frame) == want
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{FOLDER}/conversations.parquet'")
    rows = duck.execute(f"select {', '.join(COLUMNS)} from ({OP13})").fetchall()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in rows) == want


@pytest.mark.parametrize("bar, queue", [(1, 3), (4, 100), (10**6, 2)])
def test_shards_of_any_size_and_spilling_queues(spark, bar, queue):
    """One hot conversation of many turns, hot first turns, repeated rows and turns, nulls, ids of any sign."""
    draw = random.Random(bar)
    rows = [(c, t, draw.choice(["user", None]), draw.choice(["", "a", "bé", None])) for c in range(60) for t in range(draw.randrange(1, 7))]
    rows += [(c, 0, "system", "hot") for c in range(100, 180)] + [(c, 1, "user", str(c % 7)) for c in range(100, 180, 3)]
    rows += [(200, t, "user", str(t)) for t in range(3000)] + [(203, 5, "user", "own")] * 9
    rows += [(7, None, "x", "first"), (7, 0, "x", "same"), (7, 0, "x", "same"), (None, 0, "user", "nobody"), (-7, 0, "u", "t"), (-7, 1, "u", "t")]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' as depth", "1 as k1", "'x' as part", "0 as top")
    params = trie.TrieParams(least_bar=bar, queue_rows=queue)
    assert found(frame.repartition(5), params) == brute(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_queue_with_runs_gives_the_order_of_one_without():
    draw = random.Random(3)
    items = [(draw.randrange(50), draw.randrange(5), 0, i, i) for i in range(500)]
    queue = trie.SpillingQueue(17)
    out = []
    for i, item in enumerate(items):
        queue.push(item)
    assert queue.spilled > 5
    for key in sorted({item[:2] for item in items}):
        assert queue.pop((key[0], key[1], 1)) is None
        while (item := queue.pop(key)) is not None:
            out.append(item)
    assert out == sorted(items)
