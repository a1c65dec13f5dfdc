"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes weighted terms: hashed trigrams of its outline (letters, digits and white space replaced by one sign
each, other characters kept) and how often a word or line repeats the one before it. A truncated singular value
decomposition of a bounded labelled sample gives the latent space. The sample's vectors are broadcast; every text is
projected, its cosine with all of them is one block of a matrix product, and the nearest labels vote, weighted by
similarity.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import fold, free_name, labelled_sample, with_score


@dataclass(frozen=True)
class NeighbourParams:
    """Labelled rows are a bounded sample: ``per_class`` ids of each class at most, so is what is broadcast."""

    per_class: int = 1000
    bits: int = 10
    latent: int = 48
    neighbours: int = 15
    sharpness: float = 4.0
    threshold: float = 0.7
    block: int = 1 << 20


#: Terms after the trigrams: words like the one before, lines like an earlier one, words, distinct words.
EXTRA = 4


def _outline_table() -> np.ndarray:
    """Bytes to signs: lower a, upper A, digits 0, white space one blank, all beyond ASCII a, the rest itself."""
    table = np.arange(256, dtype=np.uint8)
    table[128:] = table[97:123] = 97
    table[65:91], table[48:58] = 65, 48
    table[[9, 11, 12, 13]] = 32
    return table


OUTLINE = _outline_table()


def terms(text: str, params: NeighbourParams) -> np.ndarray:
    """Term weights of the whole text; runs of one sign count once, so that words of any length look alike."""
    size = 1 << params.bits
    out = np.zeros(size + EXTRA)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    for start in range(0, len(raw), params.block):
        x = OUTLINE[raw[start : start + params.block]]
        x = x[np.flatnonzero(np.diff(x, prepend=0))].astype(np.uint32)
        if len(x) > 2:
            code = (x[:-2] << np.uint32(16)) ^ (x[1:-1] << np.uint32(8)) ^ x[2:]
            out[:size] += np.bincount((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - params.bits), minlength=size)
    total = out.sum()
    out[:size] = np.sqrt(out[:size] / max(1.0, total))
    words = text.split()
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    out[size] = np.sqrt(sum(map(eq, words, words[1:])) / n)
    out[size + 1] = np.sqrt(1 - len(set(lines)) / max(1, len(lines)))
    out[size + 2] = np.sqrt(max(0.0, 1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1))) if len(words) > 1 else 0.0
    out[size + 3] = 0.3
    return out


@dataclass
class NeighbourModel:
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    share: float
    params: NeighbourParams

    def latent(self, texts: list[str]) -> np.ndarray:
        rows = np.stack([terms(t, self.params) for t in texts]) @ self.project
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts or not len(self.labels):
            return np.full(len(texts), self.share)
        cosine = self.latent(texts) @ self.vectors.T
        k = min(self.params.neighbours, cosine.shape[1])
        nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        likeness = np.take_along_axis(cosine, nearest, 1)
        vote = np.exp(self.params.sharpness * (likeness - likeness.max(1, keepdims=True)) * 10) * self.weights[nearest]
        return (vote * self.labels[nearest]).sum(1) / vote.sum(1)


def train(rows: np.ndarray, labels: np.ndarray, share: float, params: NeighbourParams) -> NeighbourModel:
    """The latent space of the sample. Both classes are sampled alike; vote weights give the real odds back.

    With no labels, every text scores ``share``.
    """
    width = (1 << params.bits) + EXTRA
    if not len(labels):
        return NeighbourModel(np.zeros((width, 1)), np.zeros((0, 1)), labels, np.zeros(0), share, params)
    rarity = np.log((1 + len(rows)) / (1 + (rows > 0).sum(0))) + 0.25
    weighted = rows * rarity
    # right singular vectors from the small square matrix: no copy of the sample is made
    _, axes = np.linalg.eigh(weighted.T @ weighted)
    project = rarity[:, None] * axes[:, ::-1][:, : params.latent]
    vectors = rows @ project
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    of_class = {v: (labels == v).mean() for v in (0, 1)}
    real = {1: share, 0: 1 - share}
    weights = np.array([real[v] / of_class[v] for v in labels])
    return NeighbourModel(project, vectors, labels.astype(float), weights, share, params)


def fit(docs: DataFrame, labels: DataFrame, params: NeighbourParams = NeighbourParams(), label: str = "quality") -> NeighbourModel:
    """Terms are counted where the texts are; the driver gets at most ``2 * per_class`` rows of 2**bits terms."""
    sample, share = labelled_sample(labels, docs, label, params.per_class)

    def made(frames):
        for frame in frames:
            rows = [terms(text, params).astype(np.float32).tobytes() for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "h": frame["h"], "terms": rows})

    rows = (
        sample.withColumn("h", F.xxhash64("text"))
        .mapInPandas(made, "doc_id long, label int, h long, terms binary")
        # one text of an id that stands in several rows
        .groupBy("doc_id")
        .agg(F.min(F.struct("h", "label", "terms")).alias("r"))
        .select("doc_id", "r.*")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .toPandas()
    )
    matrix = np.stack([np.frombuffer(x, np.float32) for x in rows["terms"]]) if len(rows) else np.zeros((0, 1))
    return train(matrix, rows["label"].to_numpy(int), share, params)


def score_documents(docs: DataFrame, labels: DataFrame, params: NeighbourParams = NeighbourParams()) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``.

    Needs doc_id and text; other columns pass through, but for those of the three names, which are replaced. Null and
    empty texts have a vector as any other. Ties among the nearest go by the sample's order of hashed ids. No labels:
    every score is the share of class 1 among the labels, 0. An empty table gives an empty result.
    """
    model = fit(docs, labels, params)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = with_score(docs.drop("held_out", "score", "predicted"), lambda texts: shared.value.score(texts), "score")
    return scored.withColumn("held_out", fold("doc_id", 4) == 2).withColumn("predicted", (F.col("score") >= params.threshold).cast("int"))


def passing(docs: DataFrame, labels: DataFrame, params: NeighbourParams = NeighbourParams()) -> DataFrame:
    """The rows of ``docs`` that are predicted to be of good quality, all columns as they were.

    Without labels of both classes nothing is known against any row: all stay.
    """
    model = fit(docs, labels, params)
    if len(set(model.labels.tolist())) < 2:
        return docs
    shared, name = docs.sparkSession.sparkContext.broadcast(model), free_name(docs, "_score")
    scored = with_score(docs, lambda texts: shared.value.score(texts), name)
    return scored.filter(F.col(name) >= params.threshold).drop(name)
