"""Sharding: a hierarchical weighted hash tree.

A leaf (shard) draws an exponential number of rate equal to its weight from a hash of the document's id and its own
number; a rack draws the least of its shards, a region the least of its racks. The least of exponential draws is an
exponential draw whose rate is the sum of the weights, so each level picks a child in proportion to the weight below
it, and a change of weights below one node moves documents only into or out of that subtree: a new shard takes
documents only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import cut, let

DRAWS = 1 << 52


@dataclass(frozen=True)
class TreeParams:
    """``weights`` has a weight per shard; shards beyond it weigh 1."""

    shards: int = 40
    shards_per_rack: int = 4
    racks_per_region: int = 2
    weights: tuple[float, ...] = ()


def _draw(key: Column, shard: Column, weight: Column) -> Column:
    uniform = (F.pmod(F.xxhash64(key, shard), F.lit(DRAWS)) + F.lit(0.5)) / F.lit(float(DRAWS))
    return -F.ln(uniform) / weight


def _least(draws: Column) -> Column:
    """Place of the least draw; the first of equals."""
    return let(draws, lambda d: (F.array_position(d, F.array_min(d)) - 1).cast("int"))


def shard_of(key: Column, shards: int, params: TreeParams) -> Column:
    """Region, then rack, then shard: at each level the child with the least draw."""
    weights = [*params.weights[:shards], *[1.0] * (shards - len(params.weights))]
    table = F.array(*[F.lit(float(w)) for w in weights])
    rack, region = params.shards_per_rack, params.shards_per_rack * params.racks_per_region
    draws = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: _draw(key, s, F.get(table, s)))

    def descend(leaves: Column) -> Column:
        """``leaves``: draws of all shards."""

        def among(start: Column, size: int, step: int) -> Column:
            """The child of ``step`` shards with the least draw below ``start``, as its first shard."""
            firsts = F.sequence(start, F.least(start + size, F.lit(shards)) - 1, F.lit(step))
            least = F.transform(firsts, lambda s: F.array_min(F.slice(leaves, s + 1, step)))
            return start + _least(least) * step

        in_region = lambda r: let(among(r, region, rack), lambda k: among(k, rack, 1))
        return let(among(F.lit(0), -(-shards // region) * region, region), in_region)

    return let(draws, descend)


def assign(docs: DataFrame, params: TreeParams = TreeParams()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, region and rack; one row per row of ``docs``.

    Size is the text's UTF-8 bytes (null: none) plus 16. Null ids are one key. Slots count a shard's rows from 0: rows
    are numbered within the input partition they came from, and partitions by the counts before them, so no shard is
    sorted in one task, and equal rows spread as their partitions do. Only doc_id and text are read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(F.col("doc_id"), params.shards, params).alias("shard"),
        shard_of(F.col("doc_id"), params.shards + 1, params).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # kept once: both uses below must see the same row numbers
    placed = cut(placed).withColumn("_part", F.shiftright("_row", 33))
    counts = placed.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_row")) - 1
    return (
        placed.withColumn("_slot", within)
        .join(starts, ["shard", "_part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_start") + F.col("_slot")).alias("slot"),
            "grown_shard",
            F.floor(F.col("shard") / (params.shards_per_rack * params.racks_per_region)).cast("int").alias("region"),
            F.floor(F.col("shard") / params.shards_per_rack).cast("int").alias("rack"),
        )
    )
