"""The Merkle manifest against a plain tree of lists."""

from __future__ import annotations

import hashlib
import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import SF_DIR  # noqa: E402
from fixtures import edge_docs, empty_docs  # noqa: E402

from curvewright.llm import manifest  # noqa: E402
from curvewright.llm.queries import QUERIES  # noqa: E402


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root and, per leaf, the texts left and right of its way up."""
    at, paths, nodes = list(range(len(leaves))), [[] for _ in leaves], leaves
    while len(nodes) > 1:
        for i, j in enumerate(at):
            first = j // 3 * 3
            paths[i].append(("".join(nodes[first:j]), "".join(nodes[j + 1 : first + 3])))
            at[i] = j // 3
        nodes = [digest(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(rows):
    groups, made, found = {}, {}, []
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        own = sorted(groups[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        made[source] = own, tree([leaf(r, r["text"]) for r in own])
    root, above = tree([made[s][1][0] for s in order]) if order else (None, [])
    for source, up in zip(order, above, strict=True):
        own, (subroot, paths) = made[source]
        for row, path in zip(own, paths, strict=True):
            text = row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = leaf(row, text)
            for left, right in path + up:
                now = digest(left, now, right)
            proof = digest(*(a + b for a, b in path + up))
            found.append((row["doc_id"], leaf(row, row["text"]), subroot, root, proof, now, now == root))
    return found


def result(docs):
    rows = manifest.manifest(docs, manifest.without_newlines(F.col("text"), F.col("doc_id")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(manifest.proof(F.col("path")), 256),
        manifest.folded(F.col("changed_leaf"), F.col("path")).alias("now"),
    ).withColumn("verified", F.col("now") == F.col("root"))


def same(got, want):
    return sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_query_is_the_plain_tree(spark):
    got = QUERIES["op12_manifest"](spark, SF_DIR)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert same(got.collect(), expected(spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()))


@pytest.mark.parametrize("levels", [1, 7])
def test_nulls_repeats_and_long_texts(spark, monkeypatch, levels):
    """One level an exchange climbs in many rounds to the same tree."""
    monkeypatch.setattr(manifest, "LEVELS", levels)
    docs = edge_docs(spark)
    assert same(result(docs).collect(), expected(docs.collect()))


def test_one_row_repeated_a_thousand_times(spark):
    docs = spark.range(1000).selectExpr("5L as doc_id", "'a\nb' as text", "'en' as lang", "'s' as source", "3L as n_chars")
    got = result(docs)
    assert same(got.collect(), expected(docs.collect()))


def test_every_source_is_one_leaf_and_no_rows(spark):
    docs = spark.range(4).selectExpr(
        "id as doc_id", "'t' as text", "'en' as lang", "nullif(id, 2L) as source", "1L as n_chars"
    )
    docs = docs.withColumn("source", F.col("source").cast("string"))
    assert same(result(docs).collect(), expected(docs.collect()))
    assert same(result(docs.where("doc_id = 0")).collect(), expected(docs.where("doc_id = 0").collect()))
    assert result(empty_docs(spark)).collect() == []


def test_a_changed_text_breaks_its_proof_alone(spark):
    docs = edge_docs(spark).where("doc_id = 8 or doc_id > 99")
    rows = manifest.manifest(docs, F.when(F.col("doc_id") == 8, F.lit("x")).otherwise(F.col("text")))
    broken = rows.where(manifest.folded(F.col("changed_leaf"), F.col("path")) != F.col("root"))
    assert [r["doc_id"] for r in broken.collect()] == [8]
