"""Base measures and the likelihood ratio against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starmart.llm import quality_rules
from starmart.llm.quality_rules import RatioParams

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


GOOD = ["the quick brown fox number %d jumps over a lazy dog while many other animals watch from the old wooden fence near river %d" % (i, i * 7) for i in range(30)]
BAD = [" ".join(f"the&&& quick%%% fox{i % 3}### jumps*** over$$$".split() * 6) for i in range(10)]
ODD = [
    None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "a b c d e f g h i " * 5, "x " * 100, "A line\nA line\n\n \nA line\nother",
    "é ü ß 日本 " * 12, " ".join(f"w{i % 40}" for i in range(5000)), " ".join(str(i) for i in range(300)) + " " + " ".join(str(i) for i in range(50, 90)), "SHOUT " * 10 + " ".join(f"LOUD{i}" for i in range(30)),
]


def test_base_measures(spark, documents):
    texts = [*ODD, *GOOD, *BAD]
    rows = [*enumerate(texts), (3, "one"), (None, GOOD[0])]
    got = {r["doc_id"]: r.asDict() for r in quality_rules.judge(documents(rows, extra=True)).collect()}
    for i, text in enumerate(texts):
        want = plain(text)
        assert {k: got[i][k] for k in want} == want, (i, text)
    assert got[None]["n_words"] == plain(GOOD[0])["n_words"]
    assert len(quality_rules.judge(documents(rows)).collect()) == len(rows)


def test_ratio(spark, documents):
    """Counts, logarithms and means by hand, on the same hashes."""
    params = replace(RatioParams(), buckets=512)
    texts = [*GOOD, *BAD, *ODD]
    frame = documents(list(enumerate(texts)))
    rows = quality_rules.prepared(frame).select("doc_id", "_hashes", quality_rules.trusted(params).alias("t")).collect()
    pairs = sorted({(a, b) for r in rows for a, b in zip(r["_hashes"], r["_hashes"][1:])})
    of_pair = {
        (r["a"], r["b"]): r["h"]
        for r in spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.pmod(F.xxhash64("a", "b"), F.lit(512)).alias("h")).collect()
    }
    grams = {r["doc_id"]: [h % 512 for h in r["_hashes"]] + [of_pair[p] for p in zip(r["_hashes"], r["_hashes"][1:])] for r in rows}
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(grams[r["doc_id"]])
        if r["t"]:
            target.update(grams[r["doc_id"]])
    assert {r["doc_id"] for r in rows if r["t"]} >= set(range(30)) and not {r["doc_id"] for r in rows if r["t"]} & set(range(30, 40))
    n, m = sum(raw.values()), sum(target.values())
    share = lambda c, total: (c + 2 + total / 1024) / (1.5 * total + 1024)
    log = [math.log(share(target[b], m) / share(raw[b], n)) for b in range(512)]
    log = [min(max(round(x * 24), -96), 31) / 24 for x in log]
    for r in quality_rules.judge(frame, params).collect():
        mine = grams[r["doc_id"]]
        want = sum(log[b] for b in mine) / max(1, len(mine))
        assert abs(r["log_ratio"] - want) < 1e-6
        assert r["kept"] == (not r["base_failed"] and r["log_ratio"] >= params.threshold)


def test_junk_goes_and_clean_text_stays(spark, documents):
    got = {r["doc_id"]: r for r in quality_rules.judge(documents(list(enumerate([*GOOD, *BAD])))).collect()}
    assert all(got[i]["kept"] for i in range(30))
    assert not any(got[i]["kept"] for i in range(30, 40))


def test_no_python_in_the_plan_and_empty_tables(spark, documents):
    judged = quality_rules.judge(documents([]))
    assert judged.collect() == []
    plan = quality_rules.judge(documents([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_no_lookup_per_character_and_no_slice_per_window(spark, documents):
    """``translate`` looks every character up in a map, and a slice of eight words per window boxes each word eight times."""
    plan = quality_rules.judge(documents([(1, "a b")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan
    assert f", {quality_rules.WINDOW})" not in plan.replace("btrim", "")


@pytest.mark.parametrize("name", ["sf0.001"])
def test_supplied_labels(spark, name):
    """Labelled junk is rejected far more often than labelled good text."""
    folder = f"/root/testdata/{name}"
    judged = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    kept = {q: [r["kept"] for r in rows if r["quality"] == q] for q in (0, 1)}
    assert sum(kept[1]) >= 0.97 * len(kept[1])
    assert sum(kept[0]) <= 0.5 * len(kept[0])
