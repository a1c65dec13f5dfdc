"""The lattice against all segmentations, expected uses against enumeration, the base measures against plain counts."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starmart.llm import lattice
from starmart.llm.lattice import Lattice, LatticeParams

WORDS = ["the", "internationalization", "x", "ß日本", "aaaaaaaa", "q\u0301z", "12345", "w" * 39, "ab" * 40, "\U0001f600é"]


def small_lattice():
    size = lattice._processor("").get_piece_size()
    return Lattice(np.random.default_rng(0).integers(0, 50, size).astype(float), 20, LatticeParams())


def weight_of(model, part):
    piece = model.ids.get(part)
    if piece is not None:
        return float(model.logs[piece])
    return sum(model.logs[model.bytes[b]] for b in part.encode()) if len(part) == 1 else None


def test_forward_sums_all_segmentations():
    model = small_lattice()

    def brute(text):
        @lru_cache(None)
        def rest(i):
            if i == len(text):
                return 1.0
            ways = ((weight_of(model, text[i:j]), j) for j in range(i + 1, len(text) + 1))
            return sum(math.exp(w) * rest(j) for w, j in ways if w is not None)

        return math.log10(rest(0))

    found = model.log10([w.encode() for w in WORDS])
    for word, value in zip(WORDS, found):
        assert abs(value - brute("▁" + word)) < 1e-9
        assert abs(value - model.forward("▁" + word)[-1] / math.log(10)) < 1e-9


def test_long_words_do_not_overflow():
    model = small_lattice()
    words = [("abc" * 20000).encode(), ("日" * 39).encode(), "\U0001f600".encode() * 39]
    values = model.log10(words)
    assert np.isfinite(values).all() and values[0] < -10000
    assert np.isfinite(model.expected(words, np.ones(3))).all()


def test_expected_uses_against_enumeration():
    model = small_lattice()
    words, counts = ["then", "aaaa", "ß日", "on"], np.array([2.0, 1.0, 5.0, 3.0])
    want = np.zeros(len(model.logs))
    for word, times in zip(words, counts):
        text, ways = "▁" + word, []

        def cut(i, parts):
            if i == len(text):
                ways.append(parts)
            for j in range(i + 1, len(text) + 1):
                if weight_of(model, text[i:j]) is not None:
                    cut(j, [*parts, text[i:j]])

        cut(0, [])
        share = np.exp([sum(weight_of(model, p) for p in w) for w in ways])
        for w, s in zip(ways, share / share.sum() * times):
            for part in w:
                for piece in [model.ids[part]] if part in model.ids else [model.bytes[b] for b in part.encode()]:
                    want[piece] += s
    got = model.expected([w.encode() for w in words], counts)
    assert np.abs(got - want).max() < 1e-9
    one_by_one = Lattice(np.zeros(len(model.logs)), 1, LatticeParams(long=2))
    one_by_one.logs = model.logs
    assert np.abs(one_by_one.expected([w.encode() for w in words], counts) - want).max() < 1e-9


def test_probabilities_sum_to_one():
    model = small_lattice()
    total = sum(math.exp(model.logs[i]) for i in model.ids.values()) + np.exp(model.logs[model.bytes]).sum() + 10**model.end
    assert abs(total - 1) < 1e-6


def test_rounds_raise_the_likelihood(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    params = LatticeParams(prior=1e-6)
    words = lattice.word_counts(docs, params).filter("word <> ' end'").cache()
    rows = words.collect()
    listed, counts = [r["word"].encode() for r in rows], np.array([r["c"] for r in rows], float)
    values = []
    for rounds in (1, 2, 4):
        model = lattice.fitted(words, 0.5, LatticeParams(prior=1e-6, rounds=rounds))
        values.append(float((model.log10(listed) * counts).sum()))
    assert values == sorted(values)


def test_held_out_text_is_scored_better_after_fitting(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fitted = lattice.score_documents(docs).filter("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()[0]
    plain = lattice.score_documents(docs, LatticeParams(rounds=0)).filter("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()[0]
    assert fitted > plain + 1


def tokens(text):
    return (text or "").encode().lower().split() + [b" end"]


@pytest.mark.parametrize("head", [0, 4, 100])
def test_base_and_model_against_plain_python(spark, documents, head):
    texts = ["the cat sat on the mat", "The CAT\tran\x0b\x0caway", None, "", "zzyzx unknown words here", "the the the", "é É ß", "a b c"] * 4
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, ""), (3, ""), (None, "the null id"), (0, texts[0])]
    params = LatticeParams(head=head)
    got = lattice.score_documents(documents(rows, extra=True), params).collect()
    held = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 5 == 1
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v, ends = sum(counts.values()), len(counts), counts[b" end"]
    floor = math.log10(n + 0.5 * (v + 1))
    words = [w for w in counts if w != b" end"]
    model = Lattice(np.zeros(lattice._processor("").get_piece_size()), 0.5, params)
    for _ in range(params.rounds):
        model = Lattice(model.expected(words, np.array([float(counts[w]) for w in words])), ends, params)
    value = lambda w: model.end if w == b" end" else model.forward("▁" + w.decode())[-1] / math.log(10)
    want = sorted(
        (str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
         sum(math.log10(counts[w] + 0.5) - floor for w in tokens(t)), sum(map(value, tokens(t))))
        for i, t in rows
    )
    have = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    assert [x[:5] for x in have] == [x[:5] for x in want]
    for a, b in zip(have, want):
        assert abs(a[5] - b[5]) < 1e-5 and abs(a[6] - b[6]) < 1e-5


def test_frequent_words_stay_below_the_bound(spark):
    words = spark.range(1, 2000).selectExpr("'w' || id AS word", "int(2000 / id) AS c")
    for head in (0, 1, 30, 400, 5000):
        assert words.filter(lattice.frequent(words, head)).count() <= head
    assert words.filter(lattice.frequent(words, 400)).count() > 200


def test_hashes_on_both_sides(spark):
    words = ["", "a", "é日本", "x" * 100]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()
    assert [r[0] for r in rows] == [int(np.uint64(xxhash.xxh64_intdigest(w.encode(), 42)).view(np.int64)) for w in words]


def test_nothing_to_learn_from(spark, documents):
    assert lattice.score_documents(documents([])).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = lattice.score_documents(documents([(held, "some words")])).collect()[0]
    assert row["held_out"] and row["n_known"] == 0 and row["train_tokens"] == 0 and math.isfinite(row["score"])
