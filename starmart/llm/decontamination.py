"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman scores them.

Test items are a stated query set, taken in blocks of bounded size; each block is broadcast. One scan of all documents
counts in how many each n-gram of the items occurs. An item's seeds are its n-grams but for those far more common than
its rarer half: common phrases join nothing, an item that leaked into many documents still has seeds, and so have the
parts of it that stand in an edited copy besides the exact ones. A second scan finds the seeds in every whole text, and
local alignment of the passage around them with the item, word by word, scores exact, edited and paraphrased copies.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import free_name, map_lists, text_of, with_score


@dataclass(frozen=True)
class AlignParams:
    """``block_bytes`` bounds the items, as UTF-8, that are broadcast at once."""

    gram: int = 3
    rare_share: float = 0.5
    match: float = 2.0
    mismatch: float = -1.0
    gap: float = 1.0
    threshold: float = 0.5
    common: int = 4
    slack: int = 10
    least_seeds: int = 2
    block_bytes: int = 4 << 20


#: Bytes to bytes: ASCII signs and white space become blanks; letters beyond ASCII stay parts of words.
_BLANKS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_BLANKS).split()


def plain_grams(words: list[bytes], n: int) -> list[tuple[bytes, ...]]:
    """All n-grams; of fewer words, the one that they all make."""
    if 0 < len(words) < n:
        return [tuple(words)]
    return list(zip(*(words[k:] for k in range(n))))


def align(item: np.ndarray, passage: np.ndarray, params: AlignParams) -> tuple[float, int, int]:
    """Smith-Waterman over word numbers: the share of the item's full score, and where the aligned passage is.

    Gaps cost the same per word, so a row's gaps along the passage are one running maximum.
    """
    n = len(passage)
    slope = params.gap * np.arange(1, n + 1)
    before, began = np.zeros(n + 1), np.arange(n + 1)
    best, span = 0.0, (0, 0)
    for word in item:
        diagonal = before[:-1] + np.where(passage == word, params.match, params.mismatch)
        up = before[1:] - params.gap
        here = np.maximum(np.maximum(diagonal, up), 0.0)
        origin = np.where(here <= 0, np.arange(1, n + 1), np.where(diagonal >= up, began[:-1], began[1:]))
        lifted = here + slope
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted >= run, np.arange(n), 0))
        row = run - slope
        before = np.concatenate([[0.0], np.maximum(row, 0.0)])
        began = np.concatenate([[0], np.where(row > 0, origin[source], np.arange(1, n + 1))])
        end = int(row.argmax())
        if row[end] > best:
            best, span = float(row[end]), (int(began[end + 1]), end + 1)
    return best / (params.match * max(1, len(item))), span[0], span[1]


@dataclass
class Seeds:
    """A block of items: their words, and for each seed the items it may come from."""

    items: list[tuple[int, list[bytes]]]
    postings: dict[tuple[bytes, ...], list[int]]
    counts: list[int]
    params: AlignParams

    def found(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item, score, first word, words) of the best passage per item whose score reaches the threshold."""
        params = self.params
        words = plain_words(text)
        hits: dict[int, list[int]] = defaultdict(list)
        kinds: dict[int, set] = defaultdict(set)
        get = self.postings.get
        for n in (params.gram, *range(1, params.gram)):
            grams = zip(*(words[k:] for k in range(n)))
            for place, items in enumerate(map(get, grams)):
                if items:
                    for i in items:
                        if len(self.items[i][1]) >= params.gram or len(self.items[i][1]) == n:
                            hits[i].append(place)
                            kinds[i].add(tuple(words[place : place + n]))
            if not self.short:
                break
        out = []
        for i, places in hits.items():
            need = min(params.least_seeds, self.counts[i])
            if len(kinds[i]) < need:
                continue
            item_id, item = self.items[i]
            reach, best = 2 * len(item) + 2, (0.0, 0, 0)
            start = 0
            for k in range(1, len(places) + 1):
                if k == len(places) or places[k] - places[k - 1] > reach:
                    low = max(0, places[start] - reach)
                    passage = words[low : places[k - 1] + reach + params.gram]
                    codes = {w: c for c, w in enumerate(dict.fromkeys(item))}
                    numbers = np.fromiter((codes.get(w, -1) for w in passage), np.int64, len(passage))
                    score, a, b = align(np.array([codes[w] for w in item]), numbers, params)
                    best = max(best, (score, low + a, b - a))
                    start = k
            if best[0] >= params.threshold:
                out.append((item_id, best[0], best[1], best[2]))
        return sorted(out, key=lambda x: (x[0] is None, x[0]))

    def __post_init__(self):
        self.short = any(len(words) < self.params.gram for _, words in self.items)


def item_blocks(benchmark: DataFrame, params: AlignParams):
    """Lists of (item_id, words), each of bounded size; items without words are left out."""
    rows = benchmark.select("item_id", text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // params.block_bytes))
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        items = [(r["item_id"], plain_words(r["text"])) for r in part]
        yield sorted(((i, w) for i, w in items if w), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def seeds_of(docs: DataFrame, items: list[tuple[int, list[bytes]]], params: AlignParams) -> Seeds:
    """Document counts of all the items' n-grams over all documents; each item keeps those that are rare for it."""
    context = docs.sparkSession.sparkContext
    grams = {g: k for k, g in enumerate(dict.fromkeys(g for _, w in items for g in plain_grams(w, params.gram)))}
    shared = context.broadcast((grams, sorted({len(g) for g in grams})))

    def count(frames):
        known, sizes = shared.value
        total: Counter[int] = Counter()
        for frame in frames:
            for text in frame["text"]:
                words = plain_words(text)
                for n in sizes:
                    total.update({known[g] for g in filter(known.__contains__, zip(*(words[k:] for k in range(n))))})
        yield pd.DataFrame({"gram": list(total.keys()), "n": list(total.values())}, dtype="int64")

    counted = docs.select(text_of().alias("text")).mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    in_docs = {r["gram"]: r["n"] for r in counted.collect()}
    postings: dict[tuple[bytes, ...], list[int]] = defaultdict(list)
    counts = []
    for i, (_, words) in enumerate(items):
        own = sorted(set(plain_grams(words, params.gram)), key=lambda g: (in_docs.get(grams[g], 0), g))
        middle = in_docs.get(grams[own[max(0, math.ceil(len(own) * params.rare_share) - 1)]], 0)
        own = [g for g in own if in_docs.get(grams[g], 0) <= params.common * middle + params.slack]
        counts.append(len(own))
        for g in own:
            postings[g].append(i)
    return Seeds(items, dict(postings), counts, params)


def leaks(docs: DataFrame, benchmark: DataFrame, params: AlignParams = AlignParams()) -> DataFrame:
    """(doc_id, item_id, score, first_word, n_words): every document row and test item that align well enough.

    One row per document row and item, for its best passage. Only doc_id and text are read. Null or empty texts and
    items match nothing; items with equal texts each get their rows; an empty benchmark gives an empty result.
    """
    schema = "doc_id long, item_id long, score double, first_word long, n_words long"
    out = None
    for items in item_blocks(benchmark, params):
        shared = docs.sparkSession.sparkContext.broadcast(seeds_of(docs, items, params))

        def run(ids, texts, shared=shared):
            return [(d, *m) for d, text in zip(ids, texts) for m in shared.value.found(text)]

        part = map_lists(docs.select("doc_id", text_of().alias("text")), run, schema)
        out = part if out is None else out.union(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, params: AlignParams = AlignParams()) -> DataFrame:
    """The rows of ``docs`` in which no test item is found, all columns as they were."""
    for items in item_blocks(benchmark, params):
        shared = docs.sparkSession.sparkContext.broadcast(seeds_of(docs, items, params))
        best = lambda texts, shared=shared: [max((m[1] for m in shared.value.found(t)), default=0.0) for t in texts]
        name = free_name(docs, "_score")
        docs = with_score(docs, best, name).filter(F.col(name) < params.threshold).drop(name)
    return docs
