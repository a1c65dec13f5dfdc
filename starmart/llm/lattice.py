"""LM scoring: marginal probability of a text over all segmentations into the pieces of an existing vocabulary.

No piece spans white space, so a text's lattice is its words' lattices one after the other, and a word's probability
depends on nothing else. Pieces start from the vocabulary's own scores (a merge vocabulary's scores are ranks, read as
a falling power law). Expectation-maximisation over the counts of all training words weighs them anew: forward and
backward recursions in logarithms give every piece its expected use over all segmentations of every word. The score of a
text is the marginal of its lattice, the same forward recursion over every token, known or not; bytes stand for
characters the vocabulary lacks, and the end is a token of its own. Probabilities of all pieces, bytes and the end sum to one.

Words are recursed in blocks of equal length: numpy steps over places while it works on thousands of words.

Word counts come from all training documents. Of the most frequent words, a bounded number, hashes, counts and
probabilities are broadcast as arrays; the counts of all others are joined by word.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import fold, map_lists, scratch, text_of


@dataclass(frozen=True)
class LatticeParams:
    """``vocabulary`` is a sentencepiece model file (default: the installed public one). ``rounds`` of
    expectation-maximisation; ``prior`` is the weight of the vocabulary's own scores, in pieces. At most ``head`` words
    are broadcast. Words longer than ``long`` are recursed one by one."""

    vocabulary: str = ""
    prior: float = 10_000.0
    power: float = 1.0
    rounds: int = 2
    head: int = 300_000
    flush: int = 400_000
    long: int = 40


LOG10 = math.log(10)
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def _processor(path: str):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text: str) -> list[bytes]:
    """Words of the whole text with A-Z lowered; bytes.split knows the same six characters of white space."""
    return text.encode("utf-8", "replace").lower().split()


def vocabulary_weights(params: LatticeParams) -> np.ndarray:
    """Per piece its share of the vocabulary's power law; 0 for control signs."""
    sp = _processor(params.vocabulary)
    size = sp.get_piece_size()
    rank = np.array([-min(0.0, sp.get_score(i)) if not sp.is_byte(i) else float(size) for i in range(size)])
    usable = np.array([not (sp.is_control(i) or sp.is_unknown(i) or rank[i] > 1e8) for i in range(size)])
    weight = usable / (rank + 3.0) ** params.power
    return weight / weight.sum()


def hash_of_points(points: np.ndarray) -> np.ndarray:
    """Hashes of the leading 1, 2, ... columns of a block of code points, one column per length."""
    out = np.empty(points.shape, np.uint64)
    h = np.zeros(len(points), np.uint64)
    for k in range(points.shape[1]):
        h = (h + points[:, k].astype(np.uint64) + np.uint64(1)) * MIX
        out[:, k] = h ^ (h >> np.uint64(31))
    return out


class Lattice:
    """Probabilities of pieces; of words, as the sum over their segmentations, with the mark of a word's start before."""

    def __init__(self, counts: np.ndarray, ends: float, params: LatticeParams):
        """``counts``: expected uses per piece, ``ends``: uses of the end token."""
        sp = _processor(params.vocabulary)
        weight = vocabulary_weights(params)
        total = np.where(weight > 0, counts + params.prior * weight, 0.0)
        whole = total.sum() + max(ends, 0.5)
        with np.errstate(divide="ignore"):
            self.logs = np.log(total / whole)
        self.end = math.log10(max(ends, 0.5) / whole)
        self.long = params.long
        named = [(i, sp.id_to_piece(i)) for i in range(len(weight)) if weight[i] > 0 and not sp.is_byte(i)]
        self.ids = {piece: i for i, piece in named}
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.longest = max(len(piece) for _, piece in named)
        hashes = np.array([hash_of_points(_points([piece]))[0, -1] for _, piece in named], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.piece = hashes[order], np.array([i for i, _ in named])[order]
        # most parts of words are no pieces: a bit per leading 20 bits of the hashes tells so without a search
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[hashes >> np.uint64(44)] = True
        self.logs_or_none = np.append(self.logs, -np.inf)

    def log10(self, words: list[bytes]) -> np.ndarray:
        """Log10 of each word's marginal probability."""
        out = np.empty(len(words))
        for rows, points in self._blocks(words):
            out[rows] = self._ahead(self._edges(points)[0])[:, -1]
        for i, text in self._long(words):
            out[i] = self.forward(text)[-1]
        return out / LOG10

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over all segmentations of the words, each as often as it counts."""
        uses = np.zeros(len(self.logs))
        for rows, points in self._blocks(words):
            weights, pieces = self._edges(points)
            ahead, behind = self._ahead(weights), self._behind(weights)
            times, whole = counts[rows], ahead[:, -1]
            for i, (weight, piece) in enumerate(zip(weights, pieces)):
                found = piece >= 0
                found[:, 0] = True  # a single sign, if need be as bytes
                row, k = np.nonzero(found)
                share = times[row] * np.exp(ahead[row, i] + weight[row, k] + behind[row, i + k + 1] - whole[row])
                of_piece = piece[row, k]
                uses += np.bincount(np.maximum(of_piece, 0), share * (of_piece >= 0), len(uses))
                bare = of_piece < 0
                if bare.any():
                    self._to_bytes(uses, points[row[bare], i], share[bare])
        for i, text in self._long(words):
            ahead, behind = self.forward(text), self.forward(text[::-1], turned=True)[::-1]
            for a, b, weight, piece in self._single(text):
                share = counts[i] * math.exp(ahead[a] + weight + behind[b] - ahead[-1])
                if piece >= 0:
                    uses[piece] += share
                else:
                    self._to_bytes(uses, np.array([ord(text[a])]), np.array([share]))
        return uses

    def _to_bytes(self, uses: np.ndarray, points: np.ndarray, share: np.ndarray) -> None:
        for point in np.unique(points).tolist():
            for b in chr(point).encode("utf-8", "replace"):
                uses[self.bytes[b]] += share[points == point].sum()

    def _of_bytes(self, point: int) -> float:
        return float(sum(self.logs[self.bytes[b]] for b in chr(point).encode("utf-8", "replace")))

    def _blocks(self, words: list[bytes], rows: int = 4096):
        by_length: dict[int, list[tuple[int, str]]] = {}
        for i, word in enumerate(words):
            text = "▁" + word.decode("utf-8", "replace")
            if len(text) <= self.long:
                by_length.setdefault(len(text), []).append((i, text))
        for group in by_length.values():
            for start in range(0, len(group), rows):
                part = group[start : start + rows]
                yield np.array([i for i, _ in part]), _points([t for _, t in part])

    def _long(self, words: list[bytes]):
        for i, word in enumerate(words):
            if len(word) >= self.long and len(text := "▁" + word.decode("utf-8", "replace")) > self.long:
                yield i, text

    def _edges(self, points: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per start, log weight and piece (row, length - 1) of every part of the words; minus infinity where none is."""
        weights, pieces = [], []
        for i in range(points.shape[1]):
            parts = hash_of_points(points[:, i : i + self.longest])
            piece = np.full(parts.shape, -1)
            likely = self.maybe[parts >> np.uint64(44)]
            hashes = parts[likely]
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            piece[likely] = np.where(self.hashes[at] == hashes, self.piece[at], -1)
            weight = self.logs_or_none[piece]
            bare = np.flatnonzero(piece[:, 0] < 0)
            if len(bare):
                signs, which = np.unique(points[bare, i], return_inverse=True)
                weight[bare, 0] = np.array([self._of_bytes(p) for p in signs.tolist()])[which]
            weights.append(weight)
            pieces.append(piece)
        return weights, pieces

    @staticmethod
    def _ahead(weights: list[np.ndarray]) -> np.ndarray:
        n, most = len(weights), weights[0].shape[1]
        ahead = np.zeros((len(weights[0]), n + 1))
        for j in range(1, n + 1):
            ways = np.stack([ahead[:, i] + weights[i][:, j - i - 1] for i in range(max(0, j - most), j)], 1)
            ahead[:, j] = _logsum(ways)
        return ahead

    @staticmethod
    def _behind(weights: list[np.ndarray]) -> np.ndarray:
        n = len(weights)
        behind = np.zeros((len(weights[0]), n + 1))
        for i in range(n - 1, -1, -1):
            last = weights[i].shape[1]
            behind[:, i] = _logsum(weights[i] + behind[:, i + 1 : i + 1 + last])
        return behind

    def _single(self, text: str):
        """(start, end, weight, piece) of every part of one word."""
        for a in range(len(text)):
            for b in range(a + 1, min(len(text), a + self.longest) + 1):
                piece = self.ids.get(text[a:b], -1)
                if piece >= 0:
                    yield a, b, float(self.logs[piece]), piece
                elif b == a + 1:
                    yield a, b, self._of_bytes(ord(text[a])), -1

    def forward(self, text: str, turned: bool = False) -> list[float]:
        """Log marginal of every beginning of one word; ``turned``: of a word that stands backwards."""
        n, ids, longest = len(text), self.ids, self.longest
        ahead = [-math.inf] * (n + 1)
        ahead[0] = 0.0
        for i in range(n):
            for j in range(i + 1, min(n, i + longest) + 1):
                piece = ids.get(text[i:j][::-1] if turned else text[i:j], -1)
                if piece >= 0:
                    weight = float(self.logs[piece])
                elif j == i + 1:
                    weight = self._of_bytes(ord(text[i]))
                else:
                    continue
                x, y = ahead[i] + weight, ahead[j]
                if x > y:
                    x, y = y, x
                ahead[j] = y if x - y < -40 else y + math.log1p(math.exp(x - y))
        return ahead


def _points(texts: list[str]) -> np.ndarray:
    """Code points of texts of one length."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), -1)


def _logsum(ways: np.ndarray) -> np.ndarray:
    top = ways.max(1)
    return top + np.log(np.exp(ways - top[:, None]).sum(1))


def word_counts(docs: DataFrame, params: LatticeParams) -> DataFrame:
    """(word, c) over all training documents; an end per document under a word with a blank in it."""

    def count(frames):
        total: Counter[bytes] = Counter()
        make = lambda: pd.DataFrame({"word": [w.decode() for w in total], "c": list(total.values())}).astype({"c": "int64"})
        for frame in frames:
            for text in frame["text"]:
                total.update(tokens(text))
                total[b" end"] += 1
                if len(total) > params.flush:
                    yield make()
                    total.clear()
        if total:
            yield make()

    train = docs.filter(fold("doc_id", 5) != 1).select(text_of().alias("text"))
    return train.mapInPandas(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def fitted(words: DataFrame, ends: float, params: LatticeParams) -> Lattice:
    """The lattice after ``rounds`` of expectation-maximisation over (word, c); the first starts from the vocabulary.
    As many numbers come to the driver as the vocabulary has pieces."""
    size = len(vocabulary_weights(params))
    # before the first round the vocabulary's own scores decide alone
    lattice = Lattice(np.zeros(size), ends=0.5, params=params)
    for _ in range(params.rounds):
        shared = words.sparkSession.sparkContext.broadcast(lattice)

        def count(frames):
            uses = np.zeros(size)
            for frame in frames:
                uses += shared.value.expected([w.encode() for w in frame["word"]], frame["c"].to_numpy(float))
            used = np.flatnonzero(uses)
            yield pd.DataFrame({"piece": used.astype("int32"), "n": uses[used]})

        rows = words.mapInPandas(count, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        uses = np.zeros(size)
        uses[rows.column("piece").to_numpy()] = rows.column("n").to_numpy()
        lattice = Lattice(uses, ends, params)
        shared.unpersist()
    return lattice


def frequent(words: DataFrame, head: int):
    """The condition for a word to be one of the most frequent ``head`` at most: a bound on its count, in steps of
    a sixteenth of an octave, found from the number of words in each step."""
    step = F.floor(F.log2("c") * 16)
    steps = sorted(words.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["s"])
    least, total = None, 0
    for r in steps:
        total += r["n"]
        if total > head:
            break
        least = r["s"]
    return F.lit(False) if least is None else step >= least


def score_documents(docs: DataFrame, params: LatticeParams = LatticeParams()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row per row of ``docs``.

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1. Null texts are empty and have their end token only. Rows
    equal in doc_id and text have equal results. Nothing to learn from: every token is unknown, the vocabulary's own
    scores decide. Only doc_id and text are read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch(spark)
    word_counts(docs, params).write.parquet(f"{folder}/words")
    counts = spark.read.parquet(f"{folder}/words")
    known = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = known["n"] or 0, known["v"]
    ends = (counts.filter("word = ' end'").agg(F.sum("c").alias("n")).first()["n"]) or 0
    words = counts.filter("word <> ' end'")
    lattice = fitted(words, ends, params)
    shared = spark.sparkContext.broadcast(lattice)

    def scored(frames):
        for frame in frames:
            yield pd.DataFrame({"h": frame["h"], "c": frame["c"], "lp": shared.value.log10([w.encode() for w in frame["word"]])})

    common = frequent(words, params.head)
    top = words.filter(common).select(F.xxhash64("word").alias("h"), "c", "word").mapInPandas(scored, "h long, c long, lp double").toArrow()
    order = np.argsort(top.column("h").to_numpy())
    head = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy()[order] for c in ("h", "c", "lp")))
    floor = math.log10(n + 0.5 * (v + 1))

    def per_texts(doc_ids, hashes, texts):
        place: dict[bytes, int] = {}
        held = [np.array([place.setdefault(w, len(place)) for w in tokens(text)], np.int64) for text in texts]
        listed = list(place)
        known_hashes, known_counts, known_logs = head.value
        own = np.array([xxhash.xxh64_intdigest(w, 42) for w in listed], np.uint64).view(np.int64)
        at = np.minimum(np.searchsorted(known_hashes, own), max(len(known_hashes) - 1, 0))
        found = known_hashes[at] == own if len(known_hashes) else np.zeros(len(own), bool)
        c, lp = np.zeros(len(own), np.int64), np.empty(len(own))
        c[found], lp[found] = known_counts[at[found]], known_logs[at[found]]
        rest = np.flatnonzero(~found)
        lp[rest] = shared.value.log10([listed[i] for i in rest.tolist()])
        base = np.where(found, np.log10(c + 0.5) - floor, 0.0)
        rows = []
        for doc_id, h, ids in zip(doc_ids, hashes, held):
            score = float(lp[ids].sum()) + shared.value.end
            own_base = float(base[ids].sum()) + math.log10(ends + 0.5) - floor
            rare, times = np.unique(ids[~found[ids]], return_counts=True)
            rows += [(doc_id, h, listed[i].decode(), k, 0, 0, 0.0, 0.0) for i, k in zip(rare.tolist(), times.tolist())]
            # a blank and the text's hash: joins nothing, and spreads
            rows.append((doc_id, h, f" {h}", 1, len(ids) + 1, int(found[ids].sum()) + int(ends > 0), own_base, score))
        return rows

    texts = docs.select("doc_id", F.xxhash64(text_of()).alias("h"), text_of().alias("text"))
    schema = "doc_id long, h long, word string, k long, n_tokens long, n_known long, base double, score double"
    parts = map_lists(texts, per_texts, schema, 256)
    own, unknown = F.col("word").startswith(" "), math.log10(0.5) - floor
    log_c = F.when(F.col("c").isNull(), F.lit(unknown)).otherwise(F.log10(F.col("c") + 0.5) - floor)
    joined = parts.join(words.filter(~common), "word", "left").select(
        "doc_id",
        "h",
        F.when(own, 1).otherwise(0).alias("rows"),
        "n_tokens",
        F.when(own, F.col("n_known")).when(F.col("c").isNotNull(), F.col("k")).otherwise(0).alias("n_known"),
        F.when(own, F.col("base")).otherwise(F.col("k") * log_c).alias("base"),
        "score",
    )
    summed = joined.groupBy("doc_id", "h").agg(*[F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "base", "score")])
    # rows with equal ids and texts were summed together
    summed = summed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return summed.select(
        "doc_id",
        (fold("doc_id", 5) == 1).alias("held_out"),
        (F.col("n_tokens") / F.col("rows")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("rows")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
    )
