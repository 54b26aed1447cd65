"""Cross-tokenizer alignment against plain lists and dictionaries."""

from __future__ import annotations

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict

import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import SF_DIR  # noqa: E402
from fixtures import edge_docs, edge_rows, empty_docs  # noqa: E402

from curvewright.llm import alignment  # noqa: E402
from curvewright.llm.queries import QUERIES  # noqa: E402

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
A = Tokenizer.from_file(alignment.BYTE_BPE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
SPELT = {c: b for b, c in enumerate(alignment.byte_letters())}


def groups_of(text):
    """[(A ids, B ids), ...] of a text, [] where it has no tokens."""
    if not text:
        return []
    a = [(i, bytes(SPELT[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [
        (i, bytes([int(p[3:-1], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode())
        for i, p in ((i, B.id_to_piece(i)) for i in B.encode(text))
    ]
    if any(b"".join(s for _, s in side) != (" " + text).encode() for side in (a, b)):
        return []
    ends, owner = [], []
    for side in (a, b):
        at, found = 0, []
        for _, s in side:
            at += len(s)
            found.append(at)
        ends.append(found)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    for side, found in zip((a, b), ends, strict=True):
        made = defaultdict(list)
        for (i, _), end in zip(side, found, strict=True):
            made[next(c for c in cuts if c >= end)].append(i)
        owner.append(made)
    return [(owner[0][c], owner[1][c]) for c in cuts]


def expected(rows):
    groups = [groups_of(r[1]) for r in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    counts = Counter(p for link in links for p in link)
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    found = []
    for row, g, link in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        found.append((
            row[0], sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(link.values()),
            sum(m for (x, y), m in link.items() if counts[x, y] == best[x]),
            sum(m * counts[p] for p, m in link.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(found, key=str)


def test_ranks_and_the_file_s_tokenizer_agree():
    with open(alignment.PIECE_BPE, "rb") as file:
        both = alignment.tokenizers(alignment.read(alignment.BYTE_BPE), file.read())
    agreed = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and alignment.AGREED.fullmatch(chr(c))]
    for at in range(0, len(agreed), 50):
        text = " " + " ".join(f"a{c}a !{c}! {c} {c}{c}1" for c in agreed[at : at + 50]) + "  \n x"
        assert both.ranks.encode_ordinary(text) == A.encode(text, add_special_tokens=False).ids
    rng = random.Random(4)
    pieces = agreed[:200] + list("abcdefgh 'st\n\t.,-1") * 40 + ["<|endoftext|>", "  ", "the", " of", "ing"] * 40
    for _ in range(500):
        text = " " + "".join(rng.choices(pieces, k=60))
        assert both.encode_a(text) == A.encode(text, add_special_tokens=False).ids


def test_query_is_the_plain_alignment(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = expected(rows)
    got = QUERIES["op13_alignment"](spark, SF_DIR)
    assert got.columns == ["doc_id", *COLUMNS]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_edge_texts_in_small_chunks(spark):
    more = ["▁", "a▁b", "<s> </s> <|endoftext|>", "\0 x", "x" * 500, "日本" * 40, " lead", "two  spaces\r\n\t", "é" * 30 + "é"]
    rows = [r for r in edge_rows(plain=10) if r[0] != 8] + [(200 + i, t, "en", "a", 1) for i, t in enumerate(more)]
    want = expected(rows)
    docs = edge_docs(spark, rows).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        made = alignment.align(docs).withColumn("groups_sha256", alignment.spelled(F.col("groups")))
        got = alignment.with_counts(made).select("doc_id", *COLUMNS).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=str) == want
    assert sum(r[1] == 0 for r in want) == 4  # null, empty and two texts that hold U+2581


def test_no_rows_and_a_very_long_text(spark):
    assert alignment.with_counts(alignment.align(empty_docs(spark))).collect() == []
    long = [(1, "many words of one text " * 60_000), (2, "many words")]
    got = {r["doc_id"]: r for r in alignment.with_counts(alignment.align(spark.createDataFrame(long, "doc_id long, text string"))).collect()}
    assert got[1]["n_links"] >= got[1]["n_groups"] > 200_000 and got[1]["n_best"] <= got[1]["n_links"]
    assert got[2]["count_sum"] >= 2 * got[2]["n_groups"] - 1


def test_links_are_found_without_a_hash_join(monkeypatch):
    import pyarrow.acero

    def refuse(*_, **__):
        raise AssertionError("joined")

    monkeypatch.setattr(pyarrow.acero, "_perform_join", refuse)
    both = alignment.Tokenizers(alignment.read(alignment.BYTE_BPE), open(alignment.PIECE_BPE, "rb").read())
    texts = ["the cat sat", "", "aaaa " * 40, "the cat, the dog\n"]
    columns, pairs = alignment.align_texts(both, texts)
    rows = zip(*(columns[c].to_pylist() for c in ("__a", "__b", "__m")), strict=True)
    found = [list(zip(*row, strict=True)) for row in rows]
    assert [sum(m for *_, m in row) for row in found] == columns["n_links"].to_pylist()
    held = {}
    for row in found:
        for a, b, _ in row:
            held[a, b] = held.get((a, b), 0) + 1
    assert held == {(a, b): n for a, b, n in zip(*(pairs[c].to_pylist() for c in ("a", "b", "count_all")), strict=True)}
