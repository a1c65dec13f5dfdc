"""Alignment against the textbook recursion; planted exact, edited and clean copies."""

from __future__ import annotations

import random

import numpy as np
import pytest

from starmart.llm import decontamination
from starmart.llm.decontamination import AlignParams, align


def textbook(item, passage, p):
    h = np.zeros((len(item) + 1, len(passage) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (p.match if a == b else p.mismatch), h[i - 1, j] - p.gap, h[i, j - 1] - p.gap)
    return h.max() / (p.match * len(item))


def test_alignment_equals_the_textbook():
    rng = np.random.default_rng(3)
    p = AlignParams()
    for _ in range(80):
        item, passage = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(-1, 6, rng.integers(0, 25))
        score, start, end = align(item, passage, p) if len(passage) else (0.0, 0, 0)
        assert abs(score - (textbook(item, passage, p) if len(passage) else 0)) < 1e-9
        if score:  # the passage named holds the whole score
            assert abs(textbook(item, passage[start:end], p) - score) < 1e-9


WORDS = [f"word{i}" for i in range(500)]


def planted():
    rng = random.Random(8)
    items = [(k, " ".join(rng.choices(WORDS, k=rng.randint(15, 50)))) for k in range(12)]
    filler = lambda n: rng.choices(WORDS, k=n)
    docs, leaks = [], set()
    for k, (item, text) in enumerate(items):
        words = text.split()
        edited = [rng.choice(WORDS) if rng.random() < 0.15 else w for w in words if rng.random() > 0.05]
        for j, copy in enumerate((text, text.upper().replace(" ", ",  "), " ".join(edited))):
            docs.append((100 * k + j, " ".join(filler(80)) + " " + copy + ". " + " ".join(filler(80))))
            leaks.add((100 * k + j, item))
        docs.append((100 * k + 50, " ".join(filler(300))))
        docs.append((100 * k + 51, " ".join(filler(50) + words[:4] + filler(50))))
    return items, docs, leaks


@pytest.mark.parametrize("params", [AlignParams(), AlignParams(block_bytes=600)])
def test_planted_copies(spark, documents, params):
    items, docs, leaks = planted()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.leaks(documents(docs, extra=True), benchmark, params).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks and len(got) == len(leaks)
    texts = dict(docs)
    for r in got:
        if r["doc_id"] % 100 == 0:
            words = decontamination.plain_words(texts[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_words"]]
            assert r["score"] == 1.0 and words == decontamination.plain_words(dict(items)[r["item_id"]])
    clean = decontamination.without_leaks(documents(docs, extra=True), benchmark, params)
    assert {r["doc_id"] for r in clean.collect()} == set(texts) - {d for d, _ in leaks}
    assert clean.columns == documents(docs, extra=True).columns


def test_odd_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "!!!"), (4, "alpha beta"), (5, "one two three four five"), (5, "one two three four five"), (None, "nine ten eleven twelve")], "item_id long, text string")
    docs = documents([(1, "x alpha beta y"), (2, "one two three four five"), (2, "one two three four five"), (None, "nine ten eleven twelve"), (3, None), (4, ""), (5, "alpha"), (6, "z " * 50000)])
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, benchmark).collect()), key=str)
    assert got == sorted([(1, 4), (2, 5), (2, 5), (2, 5), (2, 5), (None, None)], key=str)
    assert decontamination.leaks(documents([]), benchmark).collect() == []
    assert decontamination.leaks(docs, benchmark.limit(0)).collect() == []
    assert decontamination.without_leaks(docs, benchmark.limit(0)).count() == 8


def test_items_in_many_documents_still_have_seeds(spark, documents):
    benchmark = spark.createDataFrame([(1, "a rare sentence that has leaked into nearly every document of this corpus")], "item_id long, text string")
    docs = [(i, f"start {i} a rare sentence that has leaked into nearly every document of this corpus end {i}") for i in range(50)]
    assert len(decontamination.leaks(documents(docs), benchmark).collect()) == 50
