"""Prefix trie of conversations, its subtree totals by time-forward processing.

Conversations are rebuilt (a conversation takes over the first turns of the first of its block of five), and each
distinct sequence of first turns is a node, known by its depth and 128 bits of hash. The hash of a prefix is the
exclusive-or of its turns' hashes, each mixed with its place, so prefixes are running totals that need no texts and that
a very long conversation forms in parts.

Totals flow from children to parents in time-forward order: nodes are sorted by level, deepest first (Spark's external
sort), and each leaves its total in a priority queue for its parent, which comes later. A shard is one task over whole
light subtrees: a node is light if no more than ``bar`` conversations pass through it, and a shard root is the highest
light node of its path. The totals of shard roots are added up per parent and flow on through the heavy nodes above. All
nodes together have as many members as there are rebuilt turns and roots, so at most ``heavy_rows`` nodes can be heavy:
they are broadcast, and their one pass is bounded.

Rows without a conv_id belong to no conversation and are left out; a null role or text is an empty one; turns that come
at the same place stand in the order of role and text, repeated rows are turns of their own. Other columns are ignored.
An empty table has no nodes. A SHA-256 runs through its input in order, so the ends of one node meet in one task, joined
beforehand to strings of up to 4,096 ids.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import cut

KEY = ["depth", "k1", "k2"]
PARENT = ["parent_depth", "p1", "p2"]
#: Ids per string and turns per running total are bounded by these powers of two.
ENDS_BITS, PLACE_BITS = 12, 10


@dataclass(frozen=True)
class TrieParams:
    block: int = 5  # conversations that share first turns
    shared: int = 9  # 0 to ``shared`` - 1 turns are taken over
    heavy_rows: int = 100_000
    least_bar: int = 64
    queue_rows: int = 100_000  # messages held in memory by a task


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 0, x, y, bytes) per turn; x and y are hashes of role and text.

    Rows are sorted over all tasks, so a conversation that holds a large share of them is numbered in parts.
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["turn", "role", "text"]
    spread = cut(
        rows.repartitionByRange("conv_id", *[F.col(c).asc_nulls_first() for c in order]).select(
            "*", F.spark_partition_id().alias("part")
        )
    )
    parts = spread.groupBy("conv_id", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("part")
    offsets = parts.select("conv_id", "part", (F.sum("rows").over(before) - F.col("rows")).alias("offset"))
    within = Window.partitionBy("conv_id", "part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = spread.withColumn("_place", F.row_number().over(within) - 1).join(offsets, ["conv_id", "part"])
    return placed.select(
        "conv_id",
        (F.col("_place") + F.col("offset")).alias("place"),
        F.xxhash64("role", "text").alias("x"),
        F.xxhash64(F.lit(1), "text", "role").alias("y"),
        F.octet_length("text").cast("long").alias("bytes"),
    )


def rebuilt(turns: DataFrame, params: TrieParams = TrieParams()) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, x, y, bytes) of the rebuilt turns, and (conv_id, length) of every conversation."""
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    shared = F.crc32(F.col("conv_id").cast("string")) % params.shared
    plan = lengths.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % params.block).alias("base"), shared.alias("h"))
    base_turns = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    plan = cut(
        plan.join(base_turns, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    )
    # turns of the base before place h keep their place, own turns from place h on follow them
    names, zero = ["_conv", "source", "least", "most", "shift"], F.lit(0).cast("long")
    of_base = plan.select("conv_id", "base", zero, "h", zero).toDF(*names)
    of_own = plan.select("conv_id", F.col("conv_id"), "h", F.lit(2**62), F.col("taken") - F.col("h")).toDF(*names)
    ways = of_base.unionByName(of_own)
    rows = turns.join(ways, (F.col("conv_id") == F.col("source")) & (F.col("place") >= F.col("least")) & (F.col("place") < F.col("most")))
    lengths = plan.select("conv_id", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length"))
    return rows.select(F.col("_conv").alias("conv_id"), (F.col("place") + F.col("shift")).alias("place"), "x", "y", "bytes"), lengths


def paths(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every conversation at every node it passes, with the node's key, its parent's, and the bytes of its last text."""
    turn = [F.xxhash64("place", "x", "y"), F.xxhash64("y", "place", "x")]
    salted = cut(rows.select("conv_id", "place", F.shiftright("place", PLACE_BITS).alias("part"), turn[0].alias("t1"), turn[1].alias("t2"), "bytes"))
    of_part = salted.groupBy("conv_id", "part").agg(F.bit_xor("t1").alias("all1"), F.bit_xor("t2").alias("all2"))
    before = Window.partitionBy("conv_id").orderBy("part")
    earlier = of_part.select(
        "conv_id", "part", *[F.bit_xor(f"all{i}").over(before).bitwiseXOR(F.col(f"all{i}")).alias(f"before{i}") for i in (1, 2)]
    )
    within = Window.partitionBy("conv_id", "part").orderBy("place")
    running = salted.select("*", *[F.bit_xor(f"t{i}").over(within).alias(f"in{i}") for i in (1, 2)])
    keys = [F.col(f"in{i}").bitwiseXOR(F.col(f"before{i}")) for i in (1, 2)]
    below_root = running.join(earlier, ["conv_id", "part"]).select(
        "conv_id",
        (F.col("place") + 1).alias("depth"),
        *[k.alias(f"k{i}") for i, k in enumerate(keys, 1)],
        F.col("place").alias("parent_depth"),
        *[k.bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i, k in enumerate(keys, 1)],
        "bytes",
    )
    zero = F.lit(0).cast("long")
    root = lengths.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(-1).cast("long").alias("parent_depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("bytes"))
    return below_root.unionByName(root)


class SpillingQueue:
    """The least tuple of five numbers first; beyond ``limit`` tuples sorted runs go to the task's own spill files."""

    ITEM, BLOCK = struct.Struct("<5q"), 4096

    def __init__(self, limit: int):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, item: tuple[int, ...]) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, item)

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for item in sorted(self.heap):
            file.write(self.ITEM.pack(*item))
        file.seek(0)
        self.heap.clear()
        self.spilled += 1
        self._next(self.spilled, self._read(file))

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        with file:
            while block := file.read(self.ITEM.size * self.BLOCK):
                yield from self.ITEM.iter_unpack(block)

    def _next(self, number: int, run: Iterator[tuple[int, ...]]) -> None:
        if (item := next(run, None)) is not None:
            heapq.heappush(self.runs, (item, number, run))

    def pop(self, key: tuple[int, ...]) -> tuple[int, ...] | None:
        """The least item if it begins with ``key``."""
        from_run = bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0])
        least = self.runs[0][0] if from_run else self.heap[0] if self.heap else None
        if least is None or least[: len(key)] != key:
            return None
        if from_run:
            _, number, run = heapq.heappop(self.runs)
            self._next(number, run)
            return least
        return heapq.heappop(self.heap)


def forward(nodes: DataFrame, queue_rows: int) -> DataFrame:
    """Totals of nodes that come deepest first, in each task for itself.

    ``nodes`` has the keys, ``top`` (its total leaves the task), ``worth`` (what the node itself saves) and what came from
    outside the task: ``children``, ``leaves`` and ``saved``. These three are returned as totals.
    """
    names = [*KEY, *PARENT, "top", "worth", "children", "leaves", "saved"]
    given = nodes.select(*names, *[c for c in nodes.columns if c not in names])
    first = names.index("children")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(queue_rows)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(names))]
            totals: tuple[list[int], ...] = ([], [], [])
            for depth, k1, k2, up, p1, p2, top, worth, children, leaves, saved in zip(*columns):
                key = (-depth, k1, k2)
                while (message := queue.pop(key)) is not None:
                    children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
                leaves, saved = leaves if children else 1, saved + worth
                if not top:
                    queue.push((-up, p1, p2, leaves, saved))
                for total, value in zip(totals, (children, leaves, saved)):
                    total.append(value)
            arrays = list(batch.columns)
            arrays[first:] = [*[pa.array(t, pa.int64()) for t in totals], *arrays[len(names) :]]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return given.mapInArrow(run, given.schema)


def ends(path_rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Per node at which conversations end, the SHA-256 of their ids, ascending and joined by commas."""
    last = path_rows.join(lengths, (path_rows.conv_id == lengths.conv_id) & (F.col("depth") == F.col("length")), "left_semi")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    strings = last.groupBy(*KEY, F.shiftright("conv_id", ENDS_BITS).alias("part")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for *key, _, text in zip(*[c.to_pylist() for c in batch.columns]):
                if key != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*KEY, "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, digest.hexdigest())], names=[*KEY, "ends_sha256"])

    ordered = strings.repartition(*KEY).sortWithinPartitions(*KEY, "part").select(*KEY, "part", "ids")
    return ordered.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _with_names(column: list[str], suffix: str) -> list[Column]:
    return [F.col(c).alias(c + suffix) for c in column]


def prefix_trie(conversations: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, lengths = rebuilt(cut(numbered(conversations)), params)
    lengths = cut(lengths)
    path_rows = cut(paths(rows, lengths))
    nodes = cut(
        path_rows.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.max("bytes").alias("bytes"),
            *[F.max(c).alias(c) for c in PARENT],
        )
    )
    members = nodes.agg(F.sum("n_convs")).first()[0] or 0
    bar = max(params.least_bar, -(-members // params.heavy_rows))
    heavy = nodes.filter(F.col("n_convs") > bar)
    above = F.broadcast(cut(heavy.select(*KEY)))

    # the one shard root of each conversation, found without a shuffle
    light_rows = path_rows.join(above, KEY, "left_anti")
    highest = light_rows.join(above.select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT)]), PARENT, "left_semi")
    highest = highest.unionByName(light_rows.filter("depth = 0"))
    shard = highest.select("conv_id", *_with_names(KEY, "_shard"))

    worth, zero = (F.col("n_convs") - 1) * F.col("bytes"), F.lit(0).cast("long")
    light = (
        nodes.filter(F.col("n_convs") <= bar)
        .join(shard, "conv_id")
        .withColumns({"top": (F.col("depth") == F.col("depth_shard")) & (F.col("k1") == F.col("k1_shard")) & (F.col("k2") == F.col("k2_shard")), "worth": worth, "children": zero, "leaves": zero, "saved": zero})
        .repartition("k1_shard", "k2_shard")
        .sortWithinPartitions(F.desc("depth"), "k1", "k2")
        .select(*KEY, *PARENT, "top", "worth", "children", "leaves", "saved", "conv_id", "n_convs")
    )
    light = cut(forward(light, params.queue_rows))

    sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    from_shards = light.filter("top").groupBy(*[F.col(p).alias(k) for k, p in zip(KEY, PARENT)]).agg(F.count("*").alias("children"), *sums)
    # heavy_rows rows at most, so one task holds them
    heavy = (
        heavy.join(from_shards, KEY, "left")
        .fillna(0, ["children", "leaves", "saved"])
        .withColumns({"top": F.col("depth") == 0, "worth": worth})
        .select(light.columns)
        .repartition(1)
        .sortWithinPartitions(F.desc("depth"), "k1", "k2")
    )
    heavy = cut(forward(heavy, params.queue_rows))

    parents = nodes.select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT)], F.col("conv_id").alias("parent_conv_id"))
    return (
        light.unionByName(heavy)
        .join(parents, PARENT, "left")
        .join(ends(path_rows, lengths), KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
