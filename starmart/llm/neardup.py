"""MinHash near-dedup: chosen-path set similarity join over word shingles, links confirmed on full sets, components.

Texts with equal shingle sets form one class; only classes are compared. Several independent trees branch the classes:
a node picks two places of the minwise sketch, and each class goes to the two children named by its tokens there. Two
classes of similarity s share a child per place with probability s, so similar ones meet in some node with the recall
that the trees' number sets, and others part.

A small node is compared exhaustively, in two steps: sketches of half a byte per place tell which members have a candidate
in another component, and only these meet again with their full sets, once for all nodes that share candidates. The task
joins what it confirms and returns a spanning forest, so there are never more links than members, whatever the pairs
are. A large node is compared in blocks that share two pivots. If after that no more than a block of members stand outside its largest component,
these meet all members, block by block; if more do, the node branches on. The first tree goes alone: what it has joined
need not be compared again in the others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import free_name, map_lists, scratch, text_of, with_text_value


@dataclass(frozen=True)
class JoinParams:
    """``candidate`` is the similarity of sketches from which full sets are compared, 4 deviations below the bound
    (half a byte agrees by chance in one of 16 places, which ``_likeness`` takes off).
    ``block`` members or ``weight`` shingles make a node large; a task holds about twice as many. From ``depth`` on a large node
    is compared to its end instead of branching on. A task joins ``edges`` links before they are shuffled.
    ``broadcast_ids`` bounds a broadcast; beyond it ids are shuffled."""

    words: int = 5
    percent: int = 75
    sketch: int = 96
    trees: int = 5
    branches: int = 2
    candidate: float = 0.565
    block: int = 2048
    weight: int = 2_000_000
    depth: int = 10
    edges: int = 200_000
    broadcast_ids: int = 500_000
    seed: int = 5


MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; of fewer words, of the whole sequence."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out * MIX + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def sketch_of(hashes: np.ndarray, params: JoinParams) -> np.ndarray:
    """Per place the least of the shingles' hashes under that place's function, as 32-bit numbers."""
    rng = np.random.default_rng(params.seed)
    odd = rng.integers(0, 1 << 63, params.sketch, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
    out = np.full(params.sketch, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 8192):
        part = hashes[None, start : start + 8192] * odd
        out = np.minimum(out, (part ^ (part >> np.uint64(29))).min(1) if part.shape[1] else out)
    return (_mixed(out) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def halves(sketch: np.ndarray) -> bytes:
    """The low half byte of every place, two places to a byte; the number of places is even."""
    low = (sketch & 15).astype(np.uint8)
    return (low[::2] * 16 + low[1::2]).tobytes()


def class_of(hashes: np.ndarray) -> int:
    """One number for equal sets."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64)))


def sketched(docs: DataFrame, params: JoinParams) -> DataFrame:
    """doc_id, n_shingles, class and sketch of every row; empty texts have neither class nor sketch."""

    def run(ids, texts):
        rows = []
        for doc_id, text in zip(ids, texts):
            h = shingles(text, params.words)
            sketch = sketch_of(h, params)
            # the low half byte of each place screens, branching uses all four bytes
            low = halves(sketch)
            rows.append((doc_id, len(h), class_of(h), sketch, low) if len(h) else (doc_id, 0, None, None, None))
        return rows

    schema = "doc_id long, n_shingles long, class long, sketch array<int>, bytes binary"
    return map_lists(docs.select("doc_id", text_of().alias("text")), run, schema)


def children(rows: DataFrame, params: JoinParams) -> DataFrame:
    """(path, class, n_shingles) from these and the sketch: the tokens at two places that the node's path picks."""
    place = lambda i: F.pmod(F.xxhash64("path", F.lit(i)), F.lit(params.sketch)).cast("int")
    paths = [F.xxhash64("path", place(i), F.get("sketch", place(i))) for i in range(params.branches)]
    return rows.select(F.explode(F.array_distinct(F.array(*paths))).alias("path"), "class", "n_shingles")


def stored(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, written by ``tasks`` tasks at most. Unlike a checkpoint's, its readers get as
    many tasks as its size asks for, and Spark knows its size, so that joins broadcast it if it is small."""
    folder = scratch(df.sparkSession)
    (df.coalesce(max(1, tasks)) if tasks is not None else df).write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def files(rows: int, each: int = 4096) -> int:
    """Tasks that write so many rows, a few thousand each."""
    return -(-rows // each)


def contracted(edges: DataFrame, tasks: int, centres: bool) -> DataFrame:
    """Stars (u, v) that join what the edges (u, v) of each task join; v is the least of its star, itself named with
    ``centres``."""

    def run(batches):
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up] if up in root else up
                x = root[x]
            return x

        for batch in batches:
            for u, v in zip(*[c.to_pylist() for c in batch.columns]):
                u, v = find(u), find(v)
                root[max(u, v)] = min(u, v)
        pairs = [(x, r) for x in root if (r := find(x)) != x or centres]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

    # a table may have fewer splits than that
    dealt_out = edges.select("u", "v").repartition(tasks) if tasks > 1 else edges.select("u", "v").coalesce(1)
    return dealt_out.mapInArrow(run, "u long, v long")


def components(links: DataFrame, per_task: int = JoinParams.edges) -> DataFrame:
    """(class, comp) of every class in ``links`` (a, b): the least class reachable.

    Tasks first join what their own edges join. If more than one task is needed, large stars and small stars follow in turn:
    every class hands its larger neighbours, then its smaller ones, to the least it knows. The rounds grow with the
    logarithm of a chain's length.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    tasks = max(1, files(edges.count(), per_task))
    edges, mark = stored(contracted(edges, tasks, centres=tasks == 1)), None
    if tasks == 1:
        return edges.select(F.col("u").alias("class"), F.col("v").alias("comp"))
    while True:
        # v is the smaller end: larger neighbours of a class move to the least of it and its neighbours
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    # all stars: every class names the least of its component
    return edges.select(F.col("u").alias("class"), F.col("v").alias("comp")).union(edges.select(F.col("v").alias("class"), F.col("v").alias("comp")).distinct())


def _words(halves_of: np.ndarray) -> np.ndarray:
    """Half bytes, sixteen to a 64-bit number; what is left over is zero in every row."""
    low = np.zeros((len(halves_of), -(-halves_of.shape[1] // 16) * 16), np.uint8)
    low[:, : halves_of.shape[1]] = halves_of
    return np.ascontiguousarray(low[:, ::2] * 16 + low[:, 1::2]).view(np.uint64)


def _likeness(words: np.ndarray, x: int, places: int) -> np.ndarray:
    """Estimated similarity of each member with member ``x``, from ``_words``."""
    differs = words ^ words[x]
    differs |= differs >> np.uint64(2)
    differs |= differs >> np.uint64(1)
    equal = places - np.bitwise_count(differs & np.uint64(0x1111111111111111)).sum(1, dtype=np.int64)
    return (equal / places - 1 / 16) / (15 / 16)


class _Postings:
    """Who holds which shingle, in a unit: how many shingles a member shares with each of the others, at once."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = [len(s) for s in sets]
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(codes, kind="stable")]
        self.ends = np.cumsum(np.bincount(codes))
        self.codes = np.split(codes, np.cumsum(sizes)[:-1])

    def shared(self, x: int) -> np.ndarray:
        mine = self.codes[x]
        starts = np.where(mine > 0, self.ends[mine - 1], 0)
        held = [self.holders[a:b] for a, b in zip(starts, self.ends[mine])]
        return np.bincount(np.concatenate(held), minlength=len(self.codes))


def screened(halves_of: np.ndarray, comp: np.ndarray, ask: np.ndarray, params: JoinParams) -> np.ndarray:
    """Per member of a unit, the place of the first member that candidates between components connect it with, or -1 if
    it has none; one of two candidates must ask."""
    first = np.arange(len(comp))
    active = np.zeros(len(comp), bool)
    words = _words(halves_of)
    if (comp != comp[0]).any():
        for x in np.flatnonzero(ask):
            near = (comp != comp[x]) & (_likeness(words, x, halves_of.shape[1]) >= params.candidate)
            if near.any():
                near[x] = True
                active |= near
                met = np.unique(first[near])
                if len(met) > 1:
                    first[np.isin(first, met)] = met[0]
    return np.where(active, first, -1)


#: From more candidates than this on, a member is compared with all of them at once.
FEW = 8


def _similar(a: np.ndarray, b: np.ndarray, params: JoinParams) -> bool:
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    shared = int(np.count_nonzero(many[at] == few))
    return 100 * shared >= params.percent * (len(a) + len(b) - shared)


def forest(ids: np.ndarray, halves_of: np.ndarray, comp: np.ndarray, ask: np.ndarray, sets: list[np.ndarray], params: JoinParams) -> list[tuple[int, int]]:
    """Links of a unit that join its components, each confirmed on full sets: a member's candidates in other components
    are tried, most alike first, until every one has been joined or refused."""
    comp, links = comp.copy(), []
    sizes = np.array([len(s) for s in sets])
    words, postings = _words(halves_of), None
    for x in np.flatnonzero(ask):
        like = _likeness(words, x, halves_of.shape[1])
        fits = 100 * np.minimum(sizes, sizes[x]) >= params.percent * np.maximum(sizes, sizes[x])
        near = np.flatnonzero((comp != comp[x]) & (like >= params.candidate) & fits)
        known = len(near) > FEW
        if known:
            postings = postings or _Postings(sets)
            shared = postings.shared(x)[near]
            near = near[100 * shared >= params.percent * (sizes[x] + sizes[near] - shared)]
        for y in near[np.argsort(-like[near], kind="stable")]:
            if comp[y] == comp[x]:
                continue
            if known or _similar(sets[x], sets[y], params):
                links.append((int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))))
                comp[comp == comp[y]] = comp[x]
    return links


def _units(table: pa.Table):
    """Row numbers and ids of each unit of a task; a row that stands in a unit twice counts once, as one that asks."""
    unit, ids, ask = (table.column(c).to_numpy() for c in ("unit", "class", "ask"))
    order = np.lexsort((~ask, ids, unit))
    again = np.r_[False, (unit[order][1:] == unit[order][:-1]) & (ids[order][1:] == ids[order][:-1])]
    order = order[~again]
    starts = np.flatnonzero(np.r_[True, unit[order][1:] != unit[order][:-1]]) if len(order) else []
    for part in np.split(order, starts[1:]) if len(order) else []:
        if len(part) > 1:
            yield part, ids[part], ask[part]


def _sketches(table: pa.Table, params: JoinParams) -> np.ndarray:
    both = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(-1, params.sketch // 2)
    return np.stack([both >> 4, both & 15], 2).reshape(-1, params.sketch)


def linked(units: DataFrame, comps: DataFrame, classes: DataFrame, docs: DataFrame, params: JoinParams) -> DataFrame:
    """Links (a, b) between components within units: (part, unit, class, ask). A task gets the units of one part."""

    def screen(table: pa.Table) -> pa.Table:
        halves_of, comp = _sketches(table, params), table.column("comp").to_numpy()
        keep, asks, near = [np.zeros(0, np.int64)], [np.zeros(0, bool)], [np.zeros(0, np.int64)]
        for rows, ids, ask in _units(table):
            first = screened(halves_of[rows], comp[rows], ask, params)
            active = first >= 0
            keep.append(rows[active])
            asks.append(ask[active])
            near.append(ids[first[active]])
        out = table.take(np.concatenate(keep)).drop_columns(["ask", "part"])
        out = out.append_column("ask", pa.array(np.concatenate(asks), pa.bool_()))
        return out.append_column("near", pa.array(np.concatenate(near), pa.int64()))

    named = units.join(classes.select("class", "bytes"), "class").join(comps, "class", "left")
    named = named.select("part", "unit", "class", F.coalesce("comp", "class").alias("comp"), "bytes", "ask")
    schema = "unit long, class long, comp long, bytes binary, ask boolean, near long"
    active = stored(named.groupBy("part").applyInArrow(screen, schema), files(units.count(), 1024))
    members = active.count()
    if not members:
        return links_of(docs, [])

    # classes that candidates connect meet once; if they are too many for a task, they meet in the units they came from
    groups = components(active.select(F.col("class").alias("a"), F.col("near").alias("b")))
    ids = stored(classes.select("class", "doc_id", "n_shingles").join(groups.withColumnRenamed("comp", "near"), "class"))
    sizes = ids.groupBy("near").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    large = sizes.filter((F.col("n") > params.block) | (F.col("w") > params.weight)).select("near", F.lit(True).alias("large"))
    # the large ones are fewer than a block's part of the members
    grouped = active.drop("near").join(ids.select("class", "near", "n_shingles"), "class").join(F.broadcast(large), "near", "left")
    unit, ask = F.when(F.col("large"), F.col("unit")).otherwise(F.col("near")), F.col("large").isNull() | F.col("ask")
    meets = stored(
        grouped.select(unit.alias("unit"), "class", "comp", "bytes", ask.alias("ask"), "n_shingles")
        .groupBy("unit", "class")
        .agg(*[F.first(c).alias(c) for c in ("comp", "bytes")], F.max("ask").alias("ask"), F.first("n_shingles").alias("n_shingles")),
        files(members),
    )
    rows, weight = meets.agg(F.count("*"), F.sum("n_shingles")).first()
    tasks = max(1, -(-rows // 1024), -(-4 * weight // params.weight))
    meets = meets.drop("n_shingles").withColumn("part", F.pmod(F.xxhash64("unit"), F.lit(tasks)))

    wanted = ids.select(F.col("doc_id").alias("_id"))
    wanted = F.broadcast(wanted) if ids.count() <= params.broadcast_ids else wanted
    texts = docs.select("doc_id", text_of().alias("text")).join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def shingled(frames):
        for frame in frames:
            sets = [shingles(text, params.words) for text in frame["text"]]
            yield pd.DataFrame({"class": [class_of(h) for h in sets], "set": [h.tobytes() for h in sets]})

    sets = texts.select("text").mapInPandas(shingled, "class long, set binary").join(ids.select("class"), "class", "left_semi")
    sets = sets.dropDuplicates(["class"])  # copies of one set come from rows that repeat an id

    def confirm(table: pa.Table) -> pa.Table:
        halves_of, comp = _sketches(table, params), table.column("comp").to_numpy()
        sets, links = table.column("set"), []
        for rows, ids, ask in _units(table):
            own = [np.frombuffer(sets[int(r)].as_py(), np.uint64) for r in rows]
            links += forest(ids, halves_of[rows], comp[rows], ask, own, params)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return stored(meets.join(sets, "class").groupBy("part").applyInArrow(confirm, LINK), 4 * tasks)


LINK = "a long, b long"


def links_of(docs: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    return docs.sparkSession.createDataFrame(pairs, LINK)


def near_duplicates(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class, one row per row of ``docs``.

    The component's id is the least doc_id reachable; ``kept`` is true on the rows that have that id. Null and empty
    texts have no shingles and link with nothing, not even each other: each is a component of its own. Rows with equal
    ids are one place of the graph only if their texts are. Null ids are larger than all others; a component of null
    ids only has a null id and keeps its rows. Only doc_id and text are read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = stored(sketched(docs, params))
    # the sketch does not aggregate in place, so it is fetched by a row per class
    per_class = rows.filter("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("bytes").alias("bytes")
    )
    classes = stored(per_class, files(rows.count()))
    known = classes.count()
    comps = spark.createDataFrame([], "class long, comp long")
    for trees in filter(len, (range(1), range(1, params.trees))):
        paths = F.explode(F.array(*[F.lit(t).cast("long") for t in trees]))
        level = children(classes.select("class", "n_shingles", "sketch", paths.alias("path")), params)
        most = known * len(trees)
        for depth in range(1, params.depth + 1):
            level = stored(of_size(level, params), files(most * params.branches))
            if level.isEmpty():
                break
            comps = joined_by(linked(grouped(level, params), comps, classes, docs, params), comps)
            large = level.filter("few > 1")
            if not (members := large.count()):
                break
            split = stored(standing_outside(large, comps, params), files(members))
            ends = F.lit(depth == params.depth) | (F.col("f") <= params.block)
            last = split.filter(ends)
            if not last.isEmpty():
                comps = joined_by(linked(dealt(last, params), comps, classes, docs, params), comps)
            rest = split.filter(~ends).select("path", "class")
            if not (most := rest.count()):
                break
            level = children(rest.join(classes.select("class", "n_shingles", "sketch"), "class"), params)
    # a class that nothing was linked with is a component of its own
    own = classes.select("class", "doc_id")
    least = own.join(comps, "class").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_class = own.join(comps.join(least, "comp").select("class", "component_id"), "class", "left")
    of_class = of_class.select("class", F.coalesce("component_id", "doc_id").alias("component_id"))
    joined = rows.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("class").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        "class",
    )


def joined_by(new: DataFrame, comps: DataFrame) -> DataFrame:
    """The components that new links make of those there are."""
    if new.isEmpty():
        return comps
    # a component's own links may go: its members name its least class
    return components(comps.filter("class <> comp").select(F.col("class").alias("a"), F.col("comp").alias("b")).union(new))


def of_size(level: DataFrame, params: JoinParams) -> DataFrame:
    """Nodes of two members or more: (path, class, few, pivot); ``few`` is the number of blocks, 1 for a small node, and
    two members are pivots, drawn by hash, differently in every node."""
    drawn = F.struct(F.xxhash64("class", "path").alias("h"), "class")
    sizes = level.groupBy("path").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"), F.min(drawn).alias("p"), F.max(drawn).alias("q"))
    few = F.greatest(F.ceil(F.col("n") / params.block), F.ceil(F.col("w") / params.weight)).cast("int")
    sizes = sizes.filter("n > 1").select("path", F.col("p.class").alias("p"), F.col("q.class").alias("q"), few.alias("few"))
    return level.select("path", "class").join(sizes, "path").select("path", "class", "few", F.col("class").isin(F.col("p"), F.col("q")).alias("pivot"))


def grouped(level: DataFrame, params: JoinParams) -> DataFrame:
    """Units of a level: a small node is one, a large one is cut into blocks, each with both pivots. Small units share
    tasks, as many as the rows ask for."""
    tasks = max(1, -(-level.count() // (2 * params.block)))
    small = F.col("few") == 1
    block = F.pmod(F.xxhash64("class", F.lit(2)), F.col("few")).cast("int")
    blocks = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("few") - 1)).otherwise(F.array(block))
    unit = F.when(small, F.col("path")).otherwise(F.xxhash64("path", "block"))
    placed = level.withColumn("block", F.explode(blocks)).select("class", unit.alias("unit"), small.alias("small"))
    return placed.select(_part(F.col("small"), tasks).alias("part"), "unit", "class", F.lit(True).alias("ask"))


def _part(small, tasks: int):
    """Small units share ``tasks`` parts; a block is a part of its own, with a negative number."""
    return F.when(small, F.pmod(F.xxhash64("unit"), F.lit(tasks))).otherwise(F.xxhash64("unit").bitwiseOR(F.lit(-(2**63))))


def standing_outside(large: DataFrame, comps: DataFrame, params: JoinParams) -> DataFrame:
    """Members of large nodes with several components: (path, class, few, f, outside); ``f`` members stand outside the
    node's largest component."""
    named = large.join(comps, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    parts = named.groupBy("path", "comp").agg(F.count("*").alias("n"))
    nodes = parts.groupBy("path").agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.max(F.struct("n", F.col("comp").alias("largest"))).alias("l"))
    nodes = nodes.filter("kinds > 1").select("path", (F.col("n") - F.col("l.n")).alias("f"), F.col("l.largest").alias("largest"))
    # large nodes are fewer than a block's part of the members
    return named.join(F.broadcast(nodes), "path").select("path", "class", "few", "f", (F.col("comp") != F.col("largest")).alias("outside"))


def dealt(split: DataFrame, params: JoinParams) -> DataFrame:
    """Units in which those outside a large node's largest component meet all its members: those outside are cut into
    chunks, and each chunk asks in every block and in every chunk."""
    chunks = F.greatest(F.ceil(F.col("f") / params.block), F.lit(1))
    block, chunk = F.pmod(F.xxhash64("class", F.lit(2)), F.col("few")), F.pmod(F.xxhash64("class", F.lit(1)), chunks)
    seq = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    asks = F.transform(seq(F.col("few") + chunks), lambda b: F.struct(chunk.alias("q"), b.alias("b"), F.lit(True).alias("ask")))
    answers = F.transform(seq(chunks), lambda q: F.struct(q.alias("q"), (F.col("few") + chunk).alias("b"), F.lit(False).alias("ask")))
    blocks = F.transform(seq(chunks), lambda q: F.struct(q.alias("q"), block.alias("b"), F.lit(False).alias("ask")))
    meets = F.when(F.col("outside"), F.concat(asks, answers)).otherwise(blocks)
    placed = split.withColumn("m", F.explode(meets)).select("class", F.xxhash64("path", "m.q", "m.b").alias("unit"), F.col("m.ask").alias("ask"))
    return placed.select(_part(F.lit(False), 1).alias("part"), "unit", "class", "ask")


def without_near_duplicates(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """One row of each component, all columns as they were: of those with the component's id, any one.

    Rows without shingles all stay. What goes is joined by id and class, so that wide rows are shuffled only where the
    ids to drop are too many to broadcast, and rows that repeat an id and a text.
    """
    result = stored(near_duplicates(docs, params).filter("class is not null").select("doc_id", "class", "kept"))
    keys = result.groupBy("doc_id", "class").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n"))
    keys = stored(keys.filter("not kept or n > 1"))
    gone, again = keys.filter("not kept"), keys.filter("kept")
    name = free_name(docs, "_class")

    def classes(texts: list[str]) -> list:
        found = [shingles(text, params.words) for text in texts]
        return [class_of(h) if len(h) else None for h in found]

    rows = with_text_value(docs, classes, T.LongType(), name)

    def of(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("_id_of_key"), F.col("class").alias("_class_of_key"))
        keys = F.broadcast(keys) if keys.count() <= params.broadcast_ids else keys
        return rows.join(keys, rows["doc_id"].eqNullSafe(keys["_id_of_key"]) & (rows[name] == keys["_class_of_key"]), how)

    kept = of(rows, gone, "left_anti")
    if not again.isEmpty():
        kept = of(kept, again, "left_anti").union(of(kept, again, "left_semi").dropDuplicates(["doc_id", name]))
    return kept.drop(name)
