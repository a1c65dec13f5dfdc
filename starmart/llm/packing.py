"""Best-fit packing: a grouping genetic algorithm over token pieces, as islands with elite migration.

Texts are tokenized where they are; only narrow rows of piece lengths travel. Pieces are dealt into demes of bounded
size. Several islands evolve packings of the same deme: crossover injects whole, well-filled bins of one parent into
another, bins that then hold a piece twice are dissolved, and displaced pieces go best-fit into the bins left. Between
epochs each island's best packing migrates to the next island. The best island's full bins stand; under-filled bins of
all demes are dealt anew, whole, and evolved again, so that no deme's remainder is wasted.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import cut, map_lists, text_of


@dataclass(frozen=True)
class PackParams:
    """``ranks`` is the rank file of the byte-level vocabulary (default: the installed public one); a piece longer
    than ``capacity`` cannot arise. ``deme`` bounds the pieces a task sees together."""

    capacity: int = 1024
    end_id: int = 2
    ranks: str = ""
    special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)
    deme: int = 2048
    islands: int = 3
    epochs: int = 2
    rounds: int = 2
    population: int = 6
    generations: int = 12
    full: float = 0.995
    seed: int = 11


@lru_cache(maxsize=2)
def _encoder(ranks: str, special: tuple[tuple[str, int], ...]):
    import public_tokenizers
    import tiktoken

    with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=dict(special))


def token_ids(text: str, params: PackParams = PackParams()) -> np.ndarray:
    ids = _encoder(params.ranks, params.special).encode(text, allowed_special="all")
    return np.array([*ids, params.end_id], dtype="<u4")


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a first one with the rest."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every piece of every row."""

    def run(doc_ids, texts):
        rows = []
        for doc_id, text in zip(doc_ids, texts):
            ids = token_ids(text, params)
            for k, (start, length) in enumerate(cuts(len(ids), params.capacity)):
                rows.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
        return rows

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_lists(docs.select("doc_id", text_of().alias("text")), run, schema)


class Packing:
    """Bins of piece numbers and their loads; best fit finds the fullest bin with room through a bit per free size."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.load = capacity, [], []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0

    def _offer(self, b: int) -> None:
        room = self.capacity - self.load[b]
        self.by_room[room].append(b)
        self.rooms |= 1 << room

    def add_bin(self, items: list[int], load: int) -> None:
        self.bins.append(items)
        self.load.append(load)
        self._offer(len(self.bins) - 1)

    def best_fit(self, item: int, size: int) -> None:
        fitting = self.rooms >> size
        if not fitting:
            self.add_bin([item], size)
            return
        room = size + (fitting & -fitting).bit_length() - 1
        b = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms &= ~(1 << room)
        self.bins[b].append(item)
        self.load[b] += size
        self._offer(b)

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then uneven loads, which leave more room to use."""
        return (-len(self.bins), sum(x * x for x in self.load))


def decreasing(sizes: list[int], params: PackParams, rng=None) -> Packing:
    noise = rng.integers(0, max(2, params.capacity // 16), len(sizes)) if rng is not None else np.zeros(len(sizes), int)
    out = Packing(params.capacity)
    for i in np.argsort(-(np.array(sizes) + noise), kind="stable").tolist():
        out.best_fit(i, sizes[i])
    return out


def crossover(into: Packing, donor: Packing, sizes: list[int], rng) -> Packing:
    """``into`` with some of the donor's fullest bins; no piece twice, displaced pieces best-fit in falling order."""
    fullest = sorted(range(len(donor.bins)), key=lambda b: -donor.load[b])[: max(1, len(donor.bins) // 2)]
    chosen = [b for b in fullest if rng.random() < 0.5] or fullest[:1]
    taken = {i for b in chosen for i in donor.bins[b]}
    child, displaced = Packing(into.capacity), []
    for b in chosen:
        child.add_bin(list(donor.bins[b]), donor.load[b])
    weakest = min(range(len(into.bins)), key=lambda b: into.load[b]) if into.bins else -1
    for b, items in enumerate(into.bins):
        if b == weakest or not taken.isdisjoint(items):
            displaced += [i for i in items if i not in taken]
        else:
            child.add_bin(list(items), into.load[b])
    for i in sorted(displaced, key=lambda i: -sizes[i]):
        child.best_fit(i, sizes[i])
    return child


def evolve(sizes: list[int], given: list[list[int]], params: PackParams, seed: int) -> list[int]:
    """The bin of each piece after some generations. ``given``: packings that migrated in, as a bin per piece.

    Stops early at a packing that needs no more bins than the pieces' sum does.
    """
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // params.capacity)
    people = []
    for bins in given:
        packing, members = Packing(params.capacity), {}
        for i, b in enumerate(bins):
            members.setdefault(b, []).append(i)
        for items in members.values():
            packing.add_bin(items, sum(sizes[i] for i in items))
        people.append(packing)
    people.append(decreasing(sizes, params))
    while len(people) < params.population and max(p.fitness() for p in people)[0] < -least:
        people.append(decreasing(sizes, params, rng))
    people.sort(key=Packing.fitness, reverse=True)
    for _ in range(params.generations if len(people) > 1 else 0):
        if len(people[0].bins) <= least:
            break
        a, b = rng.choice(len(people), 2, replace=False)
        people.append(crossover(people[min(a, b)], people[max(a, b)], sizes, rng))
        people.append(crossover(people[max(a, b)], people[min(a, b)], sizes, rng))
        people.sort(key=Packing.fitness, reverse=True)
        del people[params.population :]
    out = [0] * len(sizes)
    for b, items in enumerate(people[0].bins):
        for i in items:
            out[i] = b
    return out


STATE = "deme long, island int, source int, item long, length long, bin long, n_bins long, spread double"


def epoch(state: DataFrame, number: int, params: PackParams) -> DataFrame:
    """Every island of every deme evolves; a group is one island with the packings its own past and its neighbour sent."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        deme, island = int(key[0]), int(key[1])
        frame = frame.sort_values(["source", "length", "item"], kind="stable")
        sources = list(dict.fromkeys(frame["source"]))
        first = frame[frame["source"] == sources[0]]
        sizes = first["length"].tolist()
        given = [frame.loc[frame["source"] == s, "bin"].tolist() for s in sources]
        given = [g for g in given if len(g) == len(sizes) and min(g, default=0) >= 0]
        bins = evolve(sizes, given, params, hash((params.seed, deme, island, number)) & 0xFFFFFFFF)
        loads = np.bincount(bins, weights=sizes)
        return pd.DataFrame(
            {"deme": deme, "island": island, "source": 0, "item": first["item"].to_numpy(), "length": sizes, "bin": bins}
        ).assign(n_bins=len(loads), spread=float((loads**2).sum()))

    return state.groupBy("deme", "island").applyInPandas(run, STATE)


def packed_round(items: DataFrame, params: PackParams) -> DataFrame:
    """(item, length, deme, bin) for ``items`` (item, length, deme, bin); bins of -1 are no packing yet."""
    islands = F.explode(F.sequence(F.lit(0), F.lit(params.islands - 1)))
    state = items.withColumn("island", islands).select("deme", "island", F.lit(0).alias("source"), "item", "length", "bin", F.lit(0).alias("n_bins"), F.lit(0.0).alias("spread"))
    for number in range(params.epochs):
        if number:
            moved = state.withColumn("island", (F.col("island") + 1) % params.islands).withColumn("source", F.lit(1))
            state = state.union(moved)
        state = cut(epoch(state, number, params))
    best = state.groupBy("deme").agg(F.min(F.struct("n_bins", -F.col("spread"), "island")).alias("b"))
    best = best.select("deme", F.col("b.island").alias("island"))
    return state.join(best, ["deme", "island"]).select("item", "length", "deme", "bin")


def deal(rows: DataFrame, key, params: PackParams, weight: int) -> DataFrame:
    """``deme``: demes of ``params.deme`` rows on average, dealt by a hash of ``key``."""
    return rows.withColumn("deme", F.pmod(F.xxhash64(*key), F.lit(max(1, -(-weight // params.deme)))))


def pack(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row of ``docs``.

    Null texts are empty and still have their end token. Rows with equal or null ids are packed row by row. Sequences
    hold at most ``capacity`` tokens without gaps. Full pieces are sequences of their own. Only doc_id and text are
    read. An empty table gives an empty result.
    """
    made = cut(pieces(docs, params).withColumn("item", F.monotonically_increasing_id()))
    loose = made.filter(F.col("length") < params.capacity).select("item", "length")
    items = deal(loose, ["item"], params, loose.count()).withColumn("bin", F.lit(-1).cast("long"))
    done = None
    for number in range(params.rounds):
        packed = cut(packed_round(items, params))
        loads = packed.groupBy("deme", "bin").agg(F.sum("length").alias("load"))
        with_load = packed.join(loads, ["deme", "bin"])
        last = number == params.rounds - 1
        standing = with_load if last else with_load.filter(F.col("load") >= params.full * params.capacity)
        ids = standing.select("item", F.xxhash64(F.lit(number), "deme", "bin").alias("_h"), F.lit(number).alias("_round"), "deme", "bin")
        done = ids if done is None else done.union(ids)
        if not last:
            rest = cut(with_load.filter(F.col("load") < params.full * params.capacity))
            # bins move whole, so what was found so far is one of the packings to start from
            items = deal(rest.select("item", "length", F.xxhash64("deme", "bin").alias("bin")), ["bin"], params, rest.count())
            items = items.withColumn("bin", F.shiftrightunsigned("bin", 1))
    done = done.withColumn("sequence_id", (F.col("_round") * (1 << 30) + F.col("deme")) * (1 << 24) + F.col("bin"))
    placed = made.join(done.select("item", "sequence_id"), "item", "left")
    placed = placed.withColumn("sequence_id", F.coalesce("sequence_id", -1 - F.col("item")))
    ahead = Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
    )
