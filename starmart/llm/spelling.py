"""Spelling variants: words one edit apart, found through pivotal grams, and the frequent word each one stands for.

A word is a sequence of overlapping bigrams, ordered from rare to frequent over all words. Its prefix is its three
rarest bigrams (with all places of the third): among any three places two do not overlap. Its pivots are the two
disjoint prefix bigrams that the fewest words share, chosen by dynamic programming over their places. One edit spoils at
most one of two disjoint bigrams, so of two near words the one whose prefix ends earlier in the order has a pivot that
stands in the other's prefix. The index therefore holds prefixes, the probes are pivots.

Position limits: an edit behind the first pivot leaves it and all before it in place, an edit before the second pivot
leaves that one and all behind it in place, counted from the end; one of the two always holds. Of what lies on the
edited side, all but one short piece is equal too. Bigram, place, length and the equal parts are one hashed key, so a
frequent bigram makes no large group. Every hit is verified on the whole words.

Null texts have no words. A null id counts as an empty id. Repeated rows count as often as they stand there. Other columns
are ignored. An empty table gives an empty result. A word without a near word has n_near 0, no form, and is its own root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import cut, lowered, map_lists, text_of

#: The letters of a run, lower-cased.
LETTERS = "[a-zÀ-ÿ]"


@dataclass(frozen=True)
class VariantParams:
    least_length: int = 7  # code points; at least 4, so that a word has three bigrams
    least_count: int = 2
    ratio: int = 10  # a form is at least this many times as frequent as its variant
    slip: int = 31  # one run in so many is misspelt before it is counted
    piece: int = 2  # code points of the edited side that may differ between the equal parts


def words(docs: DataFrame, params: VariantParams = VariantParams()) -> DataFrame:
    """(word, n): lower-cased runs of letters, one code point deleted where the hash of id and run says so."""
    run = F.col("_run")
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(
            F.regexp_extract_all(lowered(text_of()), F.lit(f"({LETTERS}{{{params.least_length},}})"), F.lit(1))
        ).alias("_run"),
    )
    hashed = runs.select(run, F.crc32(F.concat("_id", F.lit(":"), run)).alias("_h"), F.length(run).alias("_l"))
    at = (F.col("_h") % F.col("_l")).cast("int")
    slipped = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.col("_l")))
    word = F.when(F.col("_h") % params.slip == 0, slipped).otherwise(run)
    return (
        hashed.select(word.alias("word"))
        .filter(F.length("word") >= params.least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= params.least_count)
    )


def gram_counts(rows: DataFrame) -> dict[str, int]:
    """How many places of distinct words each bigram has. There are 90 letters, so 8,100 bigrams at most."""
    starts = F.sequence(F.lit(1), F.length("word") - 1)
    grams = rows.select(F.explode(F.transform(starts, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}


def places(word: str, rank: dict[str, int], count: dict[str, int]) -> tuple[int, int, list[int]]:
    """The places of the two pivots, in order, and of the whole prefix."""
    grams = [word[i : i + 2] for i in range(len(word) - 1)]
    last = sorted(rank[g] for g in grams)[2]
    prefix = [i for i, g in enumerate(grams) if rank[g] <= last]
    best = None  # cost and places of the cheapest pair that ends here or before
    cheapest, behind = None, 0  # cheapest single gram that ends before the place at hand
    for at in prefix:
        while prefix[behind] <= at - 2:
            one = (count[grams[prefix[behind]]], prefix[behind])
            cheapest = one if cheapest is None else min(cheapest, one)
            behind += 1
        if cheapest is not None:
            pair = (cheapest[0] + count[grams[at]], cheapest[1], at)
            best = pair if best is None else min(best, pair)
    return best[1], best[2], prefix


def with_places(rows: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(word, n, first, second, prefix) of words from ``rows``."""
    rank = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    def make(words, ns):
        return [(w, n, *places(w, rank, counts)) for w, n in zip(words, ns)]

    return map_lists(rows.select("word", "n"), make, "word string, n long, first int, second int, prefix array<int>")


def _keys(side: str, word: Column, length: Column, place: Column, other: Column, piece: int) -> Column:
    """Keys under which a word whose gram at ``place`` is intact, with all before it, meets words of length ``other``.

    One key for each piece of the other word behind the gram in which the edit may lie: all before the piece and all
    behind it is equal. A word too short for the parts has no such key.
    """
    head = place + 2
    tail = other - head
    pieces = F.greatest(F.lit(1), F.ceil(tail / piece).cast("int"))

    def key(j: Column) -> Column:
        start = head + F.floor(tail * j / pieces).cast("int")
        rest = other - head - F.floor(tail * (j + 1) / pieces).cast("int")
        fits = (tail >= 0) & (start <= length) & (length - rest >= start)
        before, behind = F.substring(word, F.lit(1), start), F.substring(word, length - rest + 1, rest)
        return F.when(fits, F.xxhash64(F.lit(side), j, place, other, before, F.lit("|"), behind))

    return F.filter(F.transform(F.sequence(F.lit(0), pieces - 1), key), lambda k: k.isNotNull())


def probes(rows: DataFrame, params: VariantParams) -> DataFrame:
    """(key, word, n): each word's pivots against words of its length and one more or less."""
    length = F.length("word")
    ways = [
        _keys(side, word, length, place, length + more, params.piece)
        for side, word, place in (
            ("l", F.col("word"), F.col("first")),
            ("r", F.reverse("word"), length - 2 - F.col("second")),
        )
        for more in (-1, 0, 1)
    ]
    return rows.select(F.explode(F.concat(*ways)).alias("key"), "word", "n")


def index(rows: DataFrame, params: VariantParams) -> DataFrame:
    """(key, word, n): each word's prefix grams."""
    length = F.length("word")
    left = F.transform("prefix", lambda p: _keys("l", F.col("word"), length, p, length, params.piece))
    right = F.transform("prefix", lambda p: _keys("r", F.reverse("word"), length, length - 2 - p, length, params.piece))
    return rows.select(F.explode(F.concat(F.flatten(left), F.flatten(right))).alias("key"), "word", "n")


def near_pairs(rows: DataFrame, params: VariantParams = VariantParams()) -> DataFrame:
    """(a, a_n, b, b_n): every two of the words in ``rows`` (word, n) that are one edit apart, once, a before b."""
    placed = cut(with_places(rows, gram_counts(rows)))
    probe = probes(placed, params).select("key", F.col("word").alias("p"), F.col("n").alias("p_n"))
    hits = probe.join(index(placed, params), "key").filter(
        (F.col("p") != F.col("word")) & (F.levenshtein("p", "word", 1) == 1)
    )
    swap = F.col("p") > F.col("word")
    pairs = hits.select(
        F.least("p", "word").alias("a"),
        F.when(swap, F.col("n")).otherwise(F.col("p_n")).alias("a_n"),
        F.greatest("p", "word").alias("b"),
        F.when(swap, F.col("p_n")).otherwise(F.col("n")).alias("b_n"),
    )
    return pairs.dropDuplicates(["a", "b"])


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last.

    Every form is ``ratio`` times as frequent as its variant, so a chain is short; each round halves what is left of it.
    """
    at = cut(links.select("word", F.col("form").alias("root")))
    while True:
        step = at.select(F.col("word").alias("_w"), F.col("root").alias("_next"))
        moved = cut(at.join(step, F.col("root") == F.col("_w"), "left").select("word", "root", "_next"))
        if moved.filter(F.col("_next").isNotNull()).isEmpty():
            return at
        at = moved.select("word", F.coalesce("_next", "root").alias("root"))


def variants(docs: DataFrame, params: VariantParams = VariantParams()) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word."""
    counted = cut(words(docs, params))
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), (-F.col("b_n")).alias("less"), F.col("b").alias("other")),
            F.struct(F.col("b").alias("word"), (-F.col("a_n")).alias("less"), F.col("a").alias("other")),
        )
    )
    # the most frequent near word, the first in code point order among equals
    best = (
        near_pairs(counted, params)
        .select(both.alias("_x"))
        .groupBy(F.col("_x.word").alias("word"))
        .agg(F.count("*").alias("n_near"), F.min(F.struct("_x.less", "_x.other")).alias("best"))
    )
    known = -F.col("best.less") >= F.col("n") * params.ratio
    formed = cut(
        counted.join(best, "word", "left").select(
            "word",
            F.when(known, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(known, -F.col("best.less")).alias("form_n"),
        )
    )
    rooted = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
