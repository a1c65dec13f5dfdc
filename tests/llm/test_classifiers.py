"""Toxicity and quality: accuracy on rows held out, unseen misspellings, odd tables."""

from __future__ import annotations

import numpy as np
import pytest

from starmart.llm import neighbours, toxicity
from starmart.llm.neighbours import NeighbourParams
from starmart.llm.toxicity import SubwordParams

FOLDER = "/root/testdata/sf0.1"


def ranked(scores, labels):
    """Probability that a row of class 1 scores above one of class 0."""
    order = np.argsort(np.argsort(scores))
    one = labels == 1
    return (order[one].sum() - one.sum() * (one.sum() - 1) / 2) / (one.sum() * (~one).sum())


@pytest.mark.parametrize(("module", "label", "least_rank", "least_hits", "most_false"), [(toxicity, "toxic", 0.93, 0.8, 0.06), (neighbours, "quality", 0.98, 0.97, 0.1)])
def test_held_out_accuracy(spark, module, label, least_rank, least_hits, most_false):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scored = module.score_documents(docs.select("doc_id", "text"), labels).filter("held_out")
    rows = scored.join(labels, "doc_id").select("score", "predicted", label).toPandas()
    truth = rows[label].to_numpy()
    assert len(rows) > 500 and rows["score"].between(0, 1).all()
    assert ranked(rows["score"].to_numpy(), truth) > least_rank
    assert rows["predicted"][truth == 1].mean() > least_hits
    assert rows["predicted"][truth == 0].mean() < most_false


def test_unseen_misspellings_score_alike():
    rng = np.random.default_rng(0)
    plain = [" ".join(rng.choice(["house", "river", "garden", "window", "letter", "summer", "paper", "stone"], 30)) for _ in range(200)]
    bad = [t + " worthless idiot" for t in plain[:100]]
    params = SubwordParams(steps=200)
    bags = [toxicity.bag(t, params) for t in [*bad, *plain[100:]]]
    model = toxicity.train(bags, np.array([1] * 100 + [0] * 100), 0.5, params)
    unseen = " ".join(rng.choice(["house", "river", "garden", "window"], 30))
    clean, known, spelt = model.score([unseen, unseen + " idiot worthless", unseen + " idioot worthlesss"])
    assert known > 0.8 and spelt > 0.5 and clean < 0.3


def test_whole_long_texts_count():
    params = SubwordParams(block=64)
    text = "some words " * 200 + "idiot"
    parts = np.concatenate(list(toxicity.subwords(text, params)))
    whole = np.concatenate(list(toxicity.subwords(text, SubwordParams())))
    assert sorted(parts) == sorted(whole)


@pytest.mark.parametrize(("module", "label"), [(toxicity, "toxic"), (neighbours, "quality")])
def test_odd_tables(spark, documents, module, label):
    rows = [(i, f"plain words of text number {i} " * 8) for i in range(40)] + [(None, "no id"), (50, None), (51, ""), (52, " \n "), (3, "again"), (3, "again"), (53, "x" * 200000)]
    frame = documents(rows, extra=True)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (3, None, None), (3, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = module.score_documents(frame, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    stays = module.passing(frame, labels)
    assert stays.columns == frame.columns and stays.count() <= len(rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len(module.score_documents(frame, none).collect()) == len(rows)
    assert module.passing(frame, none).count() == len(rows)
    assert module.score_documents(documents([]), labels).collect() == []
    one = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert module.passing(frame, one).count() == len(rows)


def test_votes_weighted_by_similarity():
    params = NeighbourParams(neighbours=3)
    texts = ["good plain text with words"] * 5 + ["### $$$ ### $$$ %%%"] * 5
    labels = np.array([1] * 5 + [0] * 5)
    rows = np.stack([neighbours.terms(t, params) for t in texts])
    model = neighbours.train(rows, labels, 0.5, params)
    good, bad = model.score(["other plain text of words", "$$$ ### %%% ###"])
    assert good > 0.9 and bad < 0.1
    cosine = model.latent(["other plain text of words"]) @ model.vectors.T
    nearest = np.argsort(-cosine[0])[:3]
    votes = np.exp(params.sharpness * 10 * (cosine[0][nearest] - cosine[0][nearest].max())) * model.weights[nearest]
    assert abs(good - (votes * labels[nearest]).sum() / votes.sum()) < 1e-9


def test_labels_of_the_held_out_fold_do_not_matter(spark, documents):
    import zlib

    rows = [(i, ("bad idiot words " if i % 2 else "fine plain words ") * 10 + str(i)) for i in range(60)]
    label = lambda flip: spark.createDataFrame(
        [(i, 1, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 4 == 2)) for i in range(60)], "doc_id long, quality int, toxic int"
    )
    scores = [{r["doc_id"]: r["score"] for r in toxicity.score_documents(documents(rows), label(f)).collect()} for f in (False, True)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("value", [0, 1])
def test_labels_of_one_class_reject_nothing(spark, documents, value):
    docs = documents([(i, f"some words number {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, value, value) for i in range(20)], "doc_id long, quality int, toxic int")
    assert toxicity.passing(docs, labels).count() == neighbours.passing(docs, labels).count() == 40


def test_an_id_in_many_rows_drops_no_other_from_the_sample(spark, documents):
    """The sample is bounded by ids: rows that repeat one of them take nobody's place."""
    rows = [(i, f"text {i}") for i in range(40)] + [(3, f"copy {k}") for k in range(50)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    model = neighbours.fit(documents(rows), labels, neighbours.NeighbourParams(per_class=4))
    assert sorted(model.labels.tolist()) == [0.0] * 4 + [1.0] * 4
