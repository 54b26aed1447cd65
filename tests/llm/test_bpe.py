"""Byte-pair encoding against the tokenizer library, and the transducer against a dictionary."""

from __future__ import annotations

import os
import random
import sys
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import SF_DIR  # noqa: E402
from fixtures import NAMES, edge_docs, edge_rows, empty_docs  # noqa: E402

from curvewright.llm import bpe  # noqa: E402
from curvewright.llm.common import raw_bytes  # noqa: E402
from curvewright.llm.queries import QUERIES  # noqa: E402
from curvewright.llm.transducer import Transducer, compile_words  # noqa: E402

LIBRARY = Tokenizer.from_file(bpe.VOCABULARY)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def states_needed(entries: dict[bytes, tuple]) -> int:
    """Classes of prefixes by what may follow and what is then still to be put out."""
    prefixes = {w[:i] for w in entries for i in range(len(w) + 1)}
    def onward(prefix):
        follow = {w[len(prefix):]: entries[w] for w in entries if w.startswith(prefix)}
        common = os.path.commonprefix(list(follow.values()))
        return frozenset((rest, out[len(common):]) for rest, out in follow.items())
    return len({onward(p) for p in prefixes})


def test_transducer_is_minimal_and_knows_its_words_only(tmp_path):
    rng = random.Random(1)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 6))) + rng.choice(["", "ing", "ed", "é"]) for _ in range(300)}
    entries = {w.encode(): tuple(rng.choices(range(4), k=rng.randint(1, 4))) for w in words}
    path = tmp_path / "words.bin"
    path.write_bytes(compile_words(sorted(entries.items())))
    made = Transducer(str(path))
    assert len(made.finals) == states_needed(entries)
    import pyarrow as pa

    asked = sorted(words) + ["", "zz", "abcabcabcabc"] + [w[:-1] for w in sorted(words)]
    done, sizes, ids = made.look_up(*raw_bytes(pa.array(asked)))
    ends = np.cumsum(sizes)
    for i, word in enumerate(asked):
        assert done[i] == (word.encode() in entries)
        if done[i]:
            assert tuple(ids[ends[i] - sizes[i] : ends[i]]) == entries[word.encode()]


def test_empty_transducer(tmp_path):
    import pyarrow as pa

    path = tmp_path / "none.bin"
    path.write_bytes(compile_words([]))
    done, sizes, ids = Transducer(str(path)).look_up(*raw_bytes(pa.array(["a", ""])))
    assert not done.any() and not sizes.any() and not len(ids)


def test_words_are_split_as_the_library_does():
    enc = bpe.encoder(bpe.read(bpe.VOCABULARY))
    agreed = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and bpe.AGREED.fullmatch(chr(c))]
    assert len(agreed) > 30_000
    for at in range(0, len(agreed), 50):  # each character between letters and between signs
        text = " ".join(f"a{c}a !{c}! {c}Σ" for c in agreed[at : at + 50])
        assert [i for w in enc.words(text) for i in enc.unseen(w)] == library_ids(text)
    rng = random.Random(2)
    other = [chr(rng.choice([rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x30000)])) for _ in range(3000)]
    pieces = other + agreed[:300] * 5 + list("ab1 '\n!") * 200 + ["'s", "'LL", "<|endoftext|>", "<|", "é", "Σ"] * 50
    for _ in range(300):
        text = "".join(rng.choices(pieces, k=40))
        assert [i for w in enc.words(text) for i in enc.unseen(w)] == library_ids(text), text


def test_a_very_long_word_is_merged_in_seconds():
    rng = random.Random(3)
    word = "".join(rng.choices("abcdefgh", k=100_000))
    began = time.time()
    got = bpe.encoder(bpe.read(bpe.VOCABULARY)).merge(word)
    assert time.time() - began < 10 and got == library_ids(word)


def test_query_is_the_library(spark):
    from hashlib import sha256

    got = {r["doc_id"]: r for r in QUERIES["op11_bpe"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    for row in docs:
        ids = library_ids(row["text"])
        r = got[row["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edge_rows_small_lexicon_and_small_chunks(spark, monkeypatch):
    rows = edge_rows() + [(50, "a <|endoftext|>b<|startoftext|>", "en", "a", 1), (51, "x" * 300 + " ß" * 90, "en", "a", 1)]
    want = sorted((str(r[0]), library_ids(r[1])) for r in rows)
    for size in (0, 20, bpe.LEXICON):
        got = bpe.encode(edge_docs(spark, rows), size=size)
        assert got.columns == ["doc_id", "ids"]
        assert sorted((str(r["doc_id"]), r["ids"]) for r in got.collect()) == want
    assert bpe.encode(edge_docs(spark, rows), keep=tuple(NAMES)).columns == [*NAMES, "ids"]
    assert bpe.encode(empty_docs(spark)).collect() == []


def test_decoding_leaves_out_what_is_no_id(spark):
    rows = spark.createDataFrame([(1, [320, None, 10**6, -1, 49407]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows).collect()}
    assert got == {1: LIBRARY.decode([320, 49407], skip_special_tokens=False), 2: "", 3: ""}


def test_counts_cover_all_texts(spark):
    counts = {r["word"]: r["n"] for r in bpe.word_counts(edge_docs(spark)).collect()}
    enc = bpe.encoder(bpe.read(bpe.VOCABULARY))
    assert sum(counts.values()) == sum(len(enc.words(r[1] or "")) for r in edge_rows())


def test_frequent_words_fit_the_size_and_ties_stay_together(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 1)], "word string, n long")
    for size, want in ((0, ""), (1, "a"), (2, "a"), (3, "abc"), (4, "abcd"), (9, "abcd")):
        assert "".join(sorted(r["word"] for r in bpe.frequent(counts, size).collect())) == want
    assert bpe.frequent(counts.where("n > 9"), 3).collect() == []


def test_long_texts_reach_python_in_bounded_batches(spark):
    from curvewright.llm import common

    texts = spark.range(0, 4000, 1, 1).select("id", F.expr("repeat(concat('w', id, ' '), 1000)").alias("text"))
    sizes = common.text_map(texts, "text", ["id"], "bytes long", lambda c: [pa.array([c.nbytes] * len(c), pa.int64())])
    assert sizes.agg(F.max("bytes")).first()[0] <= 2 * common.BATCH  # 20 MB before
