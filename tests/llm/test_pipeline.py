"""Every stage of the pipeline on its own input, against brute force."""

from __future__ import annotations

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from conftest import SF_DIR  # noqa: E402
from fixtures import NAMES, edge_docs, edge_rows, empty_docs  # noqa: E402

from curvewright.llm import decontaminate, quality  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_stand_odd_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, edge_docs(spark), SF_DIR)
        kept = [c for c in NAMES if c not in ("shard", "slot")] + ["shard", "slot"] if name == "shards" else NAMES
        assert rows.columns == kept
        assert 0 < rows.count() <= 2 * len(edge_rows())
        assert stage(spark, empty_docs(spark), SF_DIR).count() == 0


def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == [*docs.columns, "shard", "slot"]
    rows = got.collect()
    original = {r["doc_id"]: r for r in docs.collect()}
    for r in rows:  # documents leave as they came
        assert all(r[c] == original[r["doc_id"]][c] for c in docs.columns)
    ids = Counter(r["doc_id"] for r in rows)
    assert max(ids.values()) <= 2
    texts = Counter(original[i]["text"] for i in ids)
    assert max(texts.values()) == 1  # no copies

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    low = {r["doc_id"] for r in quality.judge(docs, labels).where("predicted = 0").collect()}
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    dirty = {r["doc_id"] for r in decontaminate.report(docs, bench).where("contaminated").collect()}
    assert low and dirty and not ids.keys() & (low | dirty)
    slots = Counter(r["shard"] for r in rows)
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, i) for s, n in slots.items() for i in range(n)}
