"""Spelling variants against brute force over all words."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from starmart.llm import spelling
from starmart.llm.common import ASCII_LOWER
from starmart.llm.expected import OP11, crc32

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(ASCII_LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def found(docs):
    rows = spelling.variants(docs).select(*COLUMNS).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {tuple(r) for r in rows}


def test_supplied_documents_against_brute_force_and_sql(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = brute(docs.select("doc_id", "text").collect())
    assert len(want) > 1000 and any(w[1] for w in want)
    assert found(docs) == want
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    assert set(duck.execute(f"select {', '.join(COLUMNS)} from ({OP11})").fetchall()) == want


def test_chains_ties_and_repeated_grams(documents):
    words = {"bananas": 3, "bananass": 30, "bananasss": 300, "anananas": 3, "ananana": 2, "aaaaaaaa": 30, "aaaaaaa": 3,
             "bbbbbbbc": 2, "cbbbbbbc": 20, "bbbbbbbd": 20, "größere": 2, "grÖßere": 2, "grossere": 2}
    text = [(None, " ".join([w] * n).replace(" ", " - ")) for w, n in words.items()]
    rows = [*text, (1, None), (2, ""), (3, "short words only"), (3, "BANANAS 7 bananas")]
    docs = documents(rows, extra=True)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(docs) == want
    roots = {w[0]: w[2] for w in want}
    assert roots["bananas"] == "bananasss"
    forms = {w[0]: w[1] for w in want}
    assert forms["bbbbbbbc"] == "bbbbbbbd"  # of two equally frequent words the first


def test_every_edit_of_long_words_is_found(documents):
    base = "qwertzuiopasdfg"
    edits = {base[:i] + base[i + 1 :] for i in range(len(base))}
    edits |= {base[:i] + c + base[i:] for i in range(len(base) + 1) for c in "xé"}
    edits |= {base[:i] + "y" + base[i + 1 :] for i in range(len(base))}
    docs = documents([(None, f"{w} {w}") for w in sorted({*edits, base})])
    pairs = spelling.near_pairs(spelling.words(docs)).collect()
    assert len(pairs) == len({(p["a"], p["b"]) for p in pairs})
    got = {frozenset((p["a"], p["b"])) for p in pairs}
    want = brute(docs.select("doc_id", "text").collect())
    assert sum(w[4] for w in want) == 2 * len(got)
    counted = {w[0] for w in want}
    assert {frozenset((base, w)) for w in edits & counted} <= got


def test_empty_table(documents):
    assert spelling.variants(documents([])).count() == 0


def test_a_long_text(documents):
    docs = documents([(None, "abcdefgh " * 50_000), (None, "x" * 300_000), (None, "abcdefghi abcdefghi")])
    got = {r["word"]: r for r in spelling.variants(docs).collect()}
    assert got["abcdefghi"]["form"] == "abcdefgh" and got["abcdefgh"]["n"] == 50_000


def test_place_of_pivots():
    count = {"ab": 5, "bc": 1, "cd": 1, "de": 1, "ef": 9, "fg": 9}
    rank = {g: i for i, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}
    assert spelling.places("abcdefg", rank, count) == (1, 3, [1, 2, 3])


@pytest.mark.parametrize("text", ["", "a", "12:éa", "0" * 50])
def test_crc_in_sql(spark, text):
    assert duckdb.execute(f"select {crc32('t')} from (select ? as t)", [text]).fetchone()[0] == zlib.crc32(text.encode())
    assert spark.range(1).select(F.crc32(F.lit(text))).first()[0] == zlib.crc32(text.encode())
