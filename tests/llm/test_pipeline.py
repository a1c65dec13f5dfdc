"""The pipeline against plain Python: models' decisions row by row, all pairs, and valid sequences."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry_point
from starmart.llm import decontamination, neighbours, packing, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "near_dedup", "decontamination", "packing"]
    names = list(entry_point.queries())
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10


def test_run_against_plain_python(spark):
    from test_neardup import expected

    documents, labels, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = [(r["doc_id"], r["text"] or "") for r in documents.collect()]
    toxic = toxicity.fit(documents, labels)
    rows = [r for r, s in zip(rows, toxic.score([t for _, t in rows])) if s < 0.3]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    quality = neighbours.fit(frame, labels)
    rows = [r for r, s in zip(rows, quality.score([t for _, t in rows])) if s >= 0.7]
    component = {i: c for i, _, c in expected(rows)}
    rows = [r for r in rows if component[r[0]] == r[0]]
    params = decontamination.AlignParams()
    (items,) = decontamination.item_blocks(benchmark, params)
    seeds = decontamination.seeds_of(spark.createDataFrame(rows, "doc_id long, text string"), items, params)
    rows = [r for r in rows if not seeds.found(r[1])]
    want = Counter((i, len(packing.token_ids(t))) for i, t in rows)
    got = corpus_pipeline.run(spark, FOLDER).collect()
    total = Counter()
    for r in got:
        total[r["doc_id"]] += r["length"]
    assert total == Counter(dict(want.keys())) and 0 < len(total) < documents.count()
    loads = Counter()
    for r in got:
        loads[r["sequence_id"]] += r["length"]
    assert max(loads.values()) <= 1024


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
