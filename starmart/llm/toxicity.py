"""Toxicity: subword-bag embeddings, averaged, under a linear softmax; both are trained together in numpy.

A text is the bag of its words' character n-grams (3 to 5 bytes, the white space around a word included as its
border), hashed into a fixed number of buckets. Each bucket has a vector; the text's vector is their mean, and a
softmax over two classes stands on it. Misspelt or inflected words share most n-grams with the words seen, so they
score alike. As everything after the mean is linear, a trained model folds into one weight per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import fold, free_name, labelled_sample, with_score


@dataclass(frozen=True)
class SubwordParams:
    """Labelled rows are a bounded sample: ``per_class`` ids of each class at most."""

    per_class: int = 1500
    bits: int = 17
    width: int = 12
    shortest: int = 3
    longest: int = 5
    steps: int = 900
    batch: int = 32
    rate: float = 1.0
    threshold: float = 0.3
    block: int = 1 << 20
    seed: int = 7


@dataclass
class SubwordModel:
    weights: np.ndarray
    bias: float
    params: SubwordParams

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            total, n = 0.0, 0
            for ids in subwords(text, self.params):
                total += float(self.weights[ids].sum(dtype=np.float64))
                n += len(ids)
            out[i] = self.bias + total / max(1, n)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -60, 60)))


def _border_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[[9, 10, 11, 12, 13]] = 32
    return table


BORDER = _border_table()


def subwords(text: str, params: SubwordParams):
    """Bucket numbers of all n-grams of the whole text, block by block, so that memory is bounded."""
    raw = np.frombuffer(f" {text} ".lower().encode("utf-8", "replace"), np.uint8)
    for start in range(0, len(raw), params.block):
        part = BORDER[raw[start : start + params.block + params.longest - 1]]
        x, gap = part.astype(np.uint32), part == 32
        found = []
        for n in range(params.shortest, params.longest + 1):
            size = min(len(part) - n + 1, params.block)
            if size <= 0:
                break
            code, inner = x[:size].copy(), np.zeros(size, bool)
            for k in range(1, n):
                code = code * np.uint32(0x01000193) ^ x[k : k + size]
                if k < n - 1:
                    inner |= gap[k : k + size]
            code = code[~inner]
            code = (code ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            found.append(code >> np.uint32(32 - params.bits))
        if found:
            yield np.concatenate(found)


def bag(text: str, params: SubwordParams) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and their shares; at most one entry per bucket, however long the text."""
    counts = np.zeros(1 << params.bits)
    for ids in subwords(text, params):
        counts += np.bincount(ids, minlength=1 << params.bits)
    ids = np.flatnonzero(counts)
    return ids.astype(np.int32), (counts[ids] / max(1.0, counts.sum())).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float, params: SubwordParams) -> SubwordModel:
    """AdaGrad over vectors and softmax together; classes are sampled evenly, ``share`` gives the real odds back.

    Without both classes the model answers the share of class 1 for every text.
    """
    share = min(max(share, 1e-4), 1 - 1e-4)
    prior = float(np.log(share / (1 - share)))
    buckets, d = 1 << params.bits, params.width
    if len(set(labels.tolist())) < 2:
        return SubwordModel(np.zeros(buckets, np.float32), prior, params)
    rng = np.random.default_rng(params.seed)
    vectors = rng.normal(0, 0.1, (buckets, d)).astype(np.float32)
    top, shift = rng.normal(0, 0.1, (d, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen, seen_top, seen_shift = np.full(buckets, 1e-6, np.float32), np.full((d, 2), 1e-6), np.full(2, 1e-6)
    weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    size = min(params.batch, len(bags))
    passes = -(-params.steps // (len(bags) // size))
    for _ in range(passes):
        order = rng.permutation(len(bags))
        for start in range(0, len(order) - size + 1, size):
            rows = order[start : start + size]
            ids = np.concatenate([bags[i][0] for i in rows])
            used, place = np.unique(ids, return_inverse=True)
            x = np.zeros((len(rows), len(used)), np.float32)
            x[np.repeat(np.arange(len(rows)), [len(bags[i][0]) for i in rows]), place] = np.concatenate([bags[i][1] for i in rows])
            hidden = x @ vectors[used]
            logits = hidden @ top + shift
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p *= weight[rows, None] / len(rows)
            g_top, g_shift, g_vec = hidden.T @ p, p.sum(0), x.T @ (p @ top.T)
            seen[used] += (g_vec**2).mean(1)
            vectors[used] -= params.rate * g_vec / np.sqrt(seen[used])[:, None]
            seen_top += g_top**2
            seen_shift += g_shift**2
            top -= (params.rate * 0.2 * g_top / np.sqrt(seen_top)).astype(np.float32)
            shift -= (params.rate * 0.2 * g_shift / np.sqrt(seen_shift)).astype(np.float32)
    return SubwordModel((vectors @ (top[:, 1] - top[:, 0])).astype(np.float32), float(shift[1] - shift[0]) + prior, params)


def fit(docs: DataFrame, labels: DataFrame, params: SubwordParams = SubwordParams(), label: str = "toxic") -> SubwordModel:
    """Bags are made where the texts are; the driver gets at most ``2 * per_class`` of them."""
    sample, share = labelled_sample(labels, docs, label, params.per_class)

    def bags(frames):
        for frame in frames:
            made = [bag(text, params) for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "h": frame["h"], "ids": [a.tobytes() for a, _ in made], "shares": [b.astype(np.float16).tobytes() for _, b in made]})

    rows = (
        sample.withColumn("h", F.xxhash64("text"))
        .mapInPandas(bags, "doc_id long, label int, h long, ids binary, shares binary")
        # one text of an id that stands in several rows
        .groupBy("doc_id")
        .agg(F.min(F.struct("h", "label", "ids", "shares")).alias("r"))
        .select("doc_id", "r.*")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .toPandas()
    )
    made = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.float16)) for a, b in zip(rows["ids"], rows["shares"])]
    return train(made, rows["label"].to_numpy(int), share, params)


def score_documents(docs: DataFrame, labels: DataFrame, params: SubwordParams = SubwordParams()) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``.

    Needs doc_id and text; other columns pass through, but for those of the three names, which are replaced. Null and
    empty texts have no n-grams: their score is the model's constant. No labels, or one class only: every score is
    the share of class 1. An empty table gives an empty result.
    """
    model = fit(docs, labels, params)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = with_score(docs.drop("held_out", "score", "predicted"), lambda texts: shared.value.score(texts), "score")
    return scored.withColumn("held_out", fold("doc_id", 4) == 2).withColumn("predicted", (F.col("score") >= params.threshold).cast("int"))


def passing(docs: DataFrame, labels: DataFrame, params: SubwordParams = SubwordParams()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they were.

    Without labels of both classes nothing is known against any row: all stay.
    """
    model = fit(docs, labels, params)
    if not model.weights.any():
        return docs
    shared, name = docs.sparkSession.sparkContext.broadcast(model), free_name(docs, "_score")
    scored = with_score(docs, lambda texts: shared.value.score(texts), name)
    return scored.filter(F.col(name) < params.threshold).drop(name)
