"""Packing: token ids against the other library, valid sequences, and no more of them than plain best fit needs."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starmart.llm import packing
from starmart.llm.packing import PackParams

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_equal_the_other_library(text):
    assert packing.token_ids(text).tolist() == ids_of(text)


def test_ids_of_odd_texts():
    for text in ("", " ", "a<|endoftext|>b", "x" * 5000, "  two  blanks\n\n\ttabs \r\n", "I'm you'll 12345 ½ ⅷ 日本語 é é \u00a0\u2003z"):
        assert packing.token_ids(text).tolist() == ids_of(text)


def test_cuts():
    assert packing.cuts(1, 4) == [(0, 1)] and packing.cuts(4, 4) == [(0, 4)]
    assert packing.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)] and packing.cuts(8, 4) == [(0, 4), (4, 4)]


def held(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_sequences(spark, documents):
    random.seed(3)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    texts = [" ".join(random.choices(words, k=random.randint(0, 60))) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "null id"), (500, None), (501, ""), (502, "word " * 3000)]
    params = PackParams(capacity=64, deme=40)
    got = packing.pack(documents(rows, extra=True), params).collect()
    ids = {i: ids_of(t or "") for i, t in rows}
    for i in ids:
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: (r["piece"], r["sequence_id"]))
        copies = sum(j == i for j, _ in rows)
        assert sum(r["length"] for r in mine) == copies * len(ids[i])
        for r in mine:
            part = ids[i][r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        if len(ids[i]) <= 64:
            assert all(r["start"] == 0 and r["piece"] == 0 for r in mine)
    n = held(got, 64)
    sizes = [r["length"] for r in got]
    plain = packing.decreasing(sizes, PackParams(capacity=64))
    assert n <= max(len(plain.bins), -(-sum(sizes) // 64)) + 1


def test_empty_table(spark, documents):
    assert packing.pack(documents([])).collect() == []


def test_evolving_never_loses_pieces_or_bins():
    rng = np.random.default_rng(1)
    params = PackParams(capacity=100, generations=30)
    for trial in range(5):
        sizes = rng.integers(20, 60, 200).tolist()
        bins = packing.evolve(sizes, [], params, trial)
        loads = np.bincount(bins, weights=sizes)
        assert loads.max() <= 100 and len(bins) == 200 and loads.min() > 0
        assert len(loads) <= len(packing.decreasing(sizes, params).bins)
        again = packing.evolve(sizes, [bins], params, trial + 9)
        assert len(set(again)) <= len(set(bins))
    assert packing.evolve([], [], params, 0) == []


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(2)
    params = PackParams(capacity=50)
    sizes = rng.integers(1, 50, 120).tolist()
    a, b = packing.decreasing(sizes, params, rng), packing.decreasing(sizes, params, rng)
    child = packing.crossover(a, b, sizes, rng)
    assert sorted(i for items in child.bins for i in items) == list(range(120))
    assert all(sum(sizes[i] for i in items) == load <= 50 for items, load in zip(child.bins, child.load))
