"""Tokens, URLs, neighbours, quality, near copies and decontamination against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import struct
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import SF_DIR  # noqa: E402
from fixtures import NAMES, edge_docs, edge_rows, empty_docs, words  # noqa: E402

from curvewright.llm import (  # noqa: E402
    decontaminate,
    neighbours,
    quality,
    simhash,
    simhash_groups,
    tokens,
    urls,
)
from curvewright.llm.common import components  # noqa: E402
from curvewright.llm.queries import QUERIES  # noqa: E402


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- operator 1


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The public vocabulary as a unigram model of the tokenizer library.

    Its placeholder score of -1e9 for runs of spaces, beside which the library's
    single precision keeps nothing of other scores, is set to -50,000.
    """
    with open(tokens.MODEL, "rb") as file:
        raw = file.read()
    kind = raw.rindex(b"\x18\x02")  # the model type, 2: byte pairs
    raw = raw[:kind] + b"\x18\x01" + raw[kind + 2 :]
    raw = raw.replace(b"\x15" + struct.pack("<f", -1e9), b"\x15" + struct.pack("<f", -50000.0))
    path = tmp_path_factory.mktemp("vocabulary") / "unigram.model"
    path.write_bytes(raw)
    return str(path)


def test_token_counts_equal_the_library(spark, unigram):
    library = sentencepiece.SentencePieceProcessor(model_file=unigram)
    rng = random.Random(5)
    odd = ["".join(rng.choices("abcdeth▁ .,\n日🙂é_-1\"9²", k=rng.randint(1, 60))) for _ in range(500)]
    rows = [(i, t) for i, t in enumerate([*odd, *(r[1] for r in edge_rows())])]
    docs = table(spark, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    want = Counter((r["doc_id"], len(library.encode(r["text"])) if r["text"] else 0) for r in docs.collect())
    got = Counter((r["doc_id"], r["n_tokens"]) for r in tokens.token_counts(docs, unigram).collect())
    assert got == want
    assert tokens.token_counts(edge_docs(spark)).count() == len(edge_rows())
    assert tokens.token_counts(empty_docs(spark)).count() == 0


def test_ties_go_to_the_piece_that_starts_first():

    with open(tokens.MODEL, "rb") as file:
        counter = tokens.Counter(file.read())
    import ahocorasick

    counter.pieces = ahocorasick.Automaton()
    for piece, score in (("ab", -2.0), ("a", -1.0), ("b", -1.0)):
        counter.pieces.add_word(piece, (len(piece), score))
    counter.pieces.make_automaton()
    assert counter.viterbi("ab") == (1, -2.0)


# --- operator 2

URLS = [
    None, "", "no scheme", "http://", "https://Net/a", "http://a.net", "http://a.net/x?y", "http://www.example.net/en/1",
    "http://EXAMPLE.net/en/#t", "https://example.net/enx", "ftp://x.example.com/de/9?q", "http://org/fr/", "http://aorg/fr/",
    "http://b.org/fr/?x://y", "http://c.org?/fr/", "http://notexample.net/en/", "x://y://z/de/", "http://w.cheap-pills.xy/1",
    "http://freebets.example.org/en/2", "http://freebets.example.org/en/2", "http://good.name.xy/en/3\n/z",
]


def test_urls_follow_the_rules_and_spam_words(spark):
    rows = [(i, u, "<p>free bets and good names</p>", i, "r", "v") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, score long, rule string, verdict string")
    got = {r["page_id"]: r for r in urls.verdicts(pages).collect()}
    assert len(got) == len(rows)
    for i, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [
            (len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        _, rule, verdict = max(fits, default=(0, None, None))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] in ("allow", "block") and verdict in (None, got[i]["verdict"])
    assert got[18]["host_words"] == ["free", "bets", "example", "org"]
    assert got[17]["verdict"] == got[18]["verdict"] == "block" and got[20]["verdict"] == "allow"
    assert urls.verdicts(pages.where("page_id < 0")).count() == 0


def test_segmentation_is_the_most_probable_split():
    known = {"th": 50, "the": 90, "he": 40, "rein": 5, "e": 3, "re": 70, "in": 60, "therein": 1, "n": 2}
    total = 1000

    def best(name):
        if not name:
            return 0.0
        return max(
            np.log(known[name[:k]] / total if name[:k] in known else 1 / (total * 10.0**k)) + best(name[k:])
            for k in range(1, len(name) + 1)
        )

    for name in ("therein", "thxin", "rethein"):
        found = [(s, k, known[name[s : s + k]]) for s in range(len(name)) for k in range(1, 9) if name[s : s + k] in known]
        split = urls._split(name, found, total)
        score = sum(np.log(known[w] / total if w in known else 1 / (total * 10.0 ** len(w))) for w in split)
        assert "".join(split) == name and abs(score - best(name)) < 1e-9


# --- operator 4


def brute(rows, chosen, k=5):
    found = {}
    for q, a in rows:
        if chosen(q):
            scored = [(-float(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), v) for v, b in rows if v != q]
            found[q] = sorted(scored)[:k]
    return found


def test_neighbours_reach_the_recall_and_exact_scores(spark):
    data = table(spark, "embeddings")
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in data.collect()]
    want = brute(rows, lambda v: v % 50 == 0)
    got = defaultdict(list)
    for r in neighbours.nearest(data, neighbours.F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    by_id = dict(rows)
    right = 0
    for q, near in want.items():
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        for _, v, s in got[q]:
            exact = by_id[q] @ by_id[v] / (np.linalg.norm(by_id[q]) * np.linalg.norm(by_id[v]))
            assert abs(s - exact) < 1e-12
            right += -s <= near[-1][0] + 1e-12
    assert right >= 0.9 * 5 * len(want)


def test_neighbour_search_goes_on_to_the_end_of_a_path(spark):
    turn = [(i, np.array([127 * np.cos(i / 20), 127 * np.sin(i / 20)]).astype(np.int8).tobytes()) for i in range(16)]
    nodes = spark.createDataFrame(turn, "node long, vec binary")
    edges = spark.createDataFrame([(i, i + 1, 0.9) for i in range(15)], "u long, v long, s float")
    found = neighbours.search(nodes.where("node = 0"), nodes, edges).collect()
    assert sorted(r["v"] for r in found) == list(range(16))


def test_neighbours_among_many_vectors_of_one_code(spark):
    rng = np.random.default_rng(2)
    base = np.array([127, 60, -30, 90, 10, -100, 44, 3]) / 127
    rows = [(i, rng.standard_normal(8)) for i in range(200)]
    rows += [(i, base * (1 + 1e-4 * rng.standard_normal(8))) for i in range(200, 800)]  # one code or nearly
    double = np.roll(base, 3)
    rows += [(i, double * 2.0 ** (i % 400 - 200)) for i in range(1199, 799, -1)]  # one direction, exact ties
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in rows], "vec_id long, embedding array<double>")
    scaled = [(i, x / np.abs(x).max() if i < 800 else double) for i, x in rows]
    want = brute(scaled, lambda v: v % 50 == 0)
    got = defaultdict(list)
    for r in neighbours.nearest(frame, neighbours.F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q, near in want.items():
        if q >= 200:
            assert [v for v, _ in got[q]] == [v for _, v in near]


def test_neighbours_with_odd_vectors_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    rows += [(i, rows[7][1]) for i in range(100, 140)]  # a group of copies
    rows += [(200, None), (201, [0.0] * 8), (202, [1.0, None] * 4), (203, [float("nan")] * 8), (204, [1.0] * 3)]
    rows += [(205, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (7, rows[7][1]), (300, [1e200] * 8)]
    frame = spark.createDataFrame([(*r, 1.5, 2) for r in rows], "vec_id long, embedding array<double>, score double, node int")
    whole = {(v, tuple(x)) for v, x in rows if v is not None and v not in range(200, 206)}
    whole = [(v, np.array(x) / np.max(np.abs(x))) for v, x in sorted(whole)]
    want = brute(whole, lambda v: v % 50 == 0)
    got = defaultdict(list)
    for r in neighbours.nearest(frame, neighbours.F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    for q, near in want.items():
        assert [round(s, 9) for _, s in got[q]] == [round(-s, 9) for s, _ in near]
    assert [v for v, _ in got[100]] == [7, 101, 102, 103, 104]  # ties to the smaller id
    few = frame.where("vec_id in (0, 1, 2)")
    assert neighbours.nearest(few, neighbours.F.col("vec_id") == 0).count() == 2
    assert neighbours.nearest(frame.where("false"), neighbours.F.col("vec_id") == 0).count() == 0


# --- operator 5


def test_quality_is_learned_and_held_out(spark):
    import zlib

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality.judge(docs, labels).collect()
    assert len(got) == docs.count()
    right = []
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in truth:
            right.append(r["predicted"] == truth[r["doc_id"]])
    assert sum(right) >= 0.97 * len(right) > 0
    # Labels of the held-out fold change nothing.
    flipped = labels.withColumn("quality", quality.F.expr("if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality)"))
    again = quality.judge(docs, flipped)
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_quality_with_odd_rows_and_tables(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0), (7, 0, 1), (900, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.judge(docs, labels).count() == len(edge_rows())
    none = quality.judge(docs, labels.where("false")).select("score").distinct().collect()
    assert [r["score"] for r in none] == [0.5]
    assert quality.judge(empty_docs(spark), labels).count() == 0
    kept = quality.good(docs, labels.where("false"))
    assert kept.columns == NAMES and kept.count() == len(edge_rows())


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 5))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit(x, y, trees=10, depth=3)
    for row, score in zip(x[:50], model.scores(x[:50]), strict=True):
        total = model.base
        for t in range(10):
            node = 0
            for _ in range(3):
                node = 2 * node + 1 + (row[model.feature[t, node]] > model.threshold[t, node])
            total += model.leaf[t, node - 7]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((quality.fit(x, y, trees=60).scores(x) > 0.5) == y).mean() > 0.95


# --- operator 6


def fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not found:
        return 0
    parts = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(near):
    label = np.arange(len(near))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_simhash_components(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()] + [(r[0], r[1]) for r in edge_rows()]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, component int")
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    label = reach(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    least = {c: min((rows[i][0] for i in np.flatnonzero(label == c) if rows[i][0] is not None), default=None) for c in set(label)}
    want = Counter((r[0], f"{int(p):016x}", least[c]) for r, p, c in zip(rows, prints, label, strict=True))
    assert Counter(tuple(r) for r in simhash.near_copies(docs).collect()) == want
    assert simhash.near_copies(empty_docs(spark)).count() == 0


def test_links_over_many_tiles_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 2**63, 60, dtype=np.uint64) * np.uint64(2)
    values = {int(s) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for s in np.repeat(seeds, 12)}
    values = np.array(sorted(values), np.uint64)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {tuple(r) for r in components(simhash.links(frame, tile=5)).collect()}
    label = reach(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    signed = values.view(np.int64)
    groups = {frozenset(signed[label == c].tolist()) for c in set(label)}
    found = defaultdict(set)
    for node, c in got:
        found[c].add(node)
    assert {frozenset(g) for g in found.values()} == {g for g in groups if len(g) > 1}
    # A dense group keeps only as many links as connect it.
    i, j = simhash._links(np.arange(8, dtype=np.int64), np.arange(8, dtype=np.int64), True, 3)
    assert len(i) <= 16


def test_similar_groups_keep_one_document(spark):
    rng = random.Random(9)
    rows = edge_rows()
    for n in range(12):
        origin = words(rng, rng.randint(40, 200)).split()
        for c in range(rng.randint(2, 9)):  # edits from none to too many
            copy = list(origin)
            for _ in range(rng.randint(0, len(copy) // 30)):
                copy[rng.randrange(len(copy))] = words(rng, 1)
            rows.append((1000 + 10 * n + c, " ".join(copy), "en", "a", 1))
    texts = [r[1] for r in rows]

    def shingles(text):
        found = lower(text).encode().split()
        return {b" ".join(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    sets = [shingles(t) for t in texts]
    alike = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    label = reach(np.array([[alike(a, b) for b in sets] for a in sets]))
    want = Counter(min((rows[i][0] for i in np.flatnonzero(label == c) if rows[i][0] is not None), default=None) for c in set(label))
    got = simhash_groups.one_of_each(edge_docs(spark, rows))
    assert got.columns == NAMES
    assert Counter(r["doc_id"] for r in got.collect()) == want
    assert simhash_groups.one_of_each(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("order", [[0, 1, 2], [1, 0, 2], [2, 1, 0], [2, 0, 1]])
def test_a_tile_meets_itself_in_any_order_of_rows(order):
    ids, zeros = [30, 10, 20], [0] * 3
    left = pa.table({"id": ids, "n": [50] * 3, **{w: zeros for w in simhash_groups.WORDS}})
    right = left.rename_columns(["r" + c for c in left.column_names]).take(order)
    links = simhash_groups._compare(left, right).to_pylist()
    label = {i: i for i in ids}
    for link in links:
        old, new = label[link["a"]], label[link["b"]]
        label = {i: new if c == old else c for i, c in label.items()}
    assert len(set(label.values())) == 1 and len(links) == 2


@pytest.mark.parametrize(("common", "beyond", "far"), [(80, 54, 64), (40, 58, 74)])
def test_similar_sets_with_unlucky_fingerprints_are_candidates(common, beyond, far):
    rng, tried = np.random.default_rng(5), 0
    while tried < 5:  # pairs of similarity 0.8 whose fingerprints differ in many bits
        rows = rng.integers(0, 2**64, (common * 5 // 4, 2), dtype=np.uint64)
        own = common // 8
        a, b = (set_table([x]) for x in (rows[: common + own], np.delete(rows, np.s_[:own], axis=0)))
        bits = sum(((a[w][0].as_py() ^ b[w][0].as_py()) % 2**64).bit_count() for w in simhash_groups.WORDS)
        if beyond < bits <= far:
            tried += 1
            assert len(simhash_groups._compare(a, b.rename_columns(["r" + c for c in b.column_names]))) == 1


def set_table(sets):
    made = np.array([simhash_groups._print(s) for s in sets]).T
    return pa.table(dict(zip(("id", "n", *simhash_groups.WORDS), made, strict=True)))


@pytest.mark.parametrize(("sizes", "count"), [((4, 5), 6000), ((6, 6), 6000), ((8, 10), 6000), ((10, 10), 6000)])
def test_unrelated_sets_of_few_shingles_are_no_candidates(sizes, count):
    rng = np.random.default_rng(8)
    a, b = (set_table(rng.integers(0, 2**64, (count, n, 2), dtype=np.uint64)) for n in sizes)
    assert len(simhash_groups._compare(a, b.rename_columns(["r" + c for c in b.column_names]))) <= 2


def test_many_unrelated_short_texts_join_no_group(spark):
    words = [F.xxhash64("id", F.lit(i)).alias(w) for i, w in enumerate(simhash_groups.WORDS)]
    sets = spark.range(200_000).select("id", (F.lit(30) + F.col("id") % 8).alias("n"), *words)
    # 2 * 10^10 pairs at 5.6e-12 each: 0.11 by chance are expected, which sets then decide.
    assert simhash_groups.candidate_links(sets).count() <= 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {7: 7} | {i: 7 for i in range(200, 260)}


# --- operator 7


def test_decontamination_equals_window_search(spark):
    rng = random.Random(11)
    items = [(1, words(rng, 30)), (2, words(rng, 10)), (3, "short item only"), (4, None), (5, " .,! "), (None, words(rng, 14))]
    items += [(1, items[0][1]), (6, items[0][1] + " tail")]
    cut = items[0][1].split()
    texts = [
        " ".join(cut[:9]), "x " + ", ".join(cut[5:16]).upper() + " y", " ".join(cut[3:20]) + " z " + " ".join(cut[3:20]),
        "a SHORT-item: only b", items[1][1] + "x", "日本語" + items[1][1] + "日本", "- ".join(items[5][1].split()), None, "", "...",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, texts[2])] + [(r[0], r[1]) for r in edge_rows()]
    docs = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, key string, n_hit int")
    bench = spark.createDataFrame([(*r, 3) for r in items], "item_id long, text string, span int")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, text in items:
        own = find(text)
        for i in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[i : i + 10])].add(item)
    want = Counter()
    for doc_id, text in rows:
        own, hit, found = find(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if there := windows.get(tuple(own[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= there
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        want[(doc_id, len(own), len(hit), len(ids), digest, bool(hit))] += 1
    assert Counter(tuple(r) for r in decontaminate.report(docs, bench).collect()) == want
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(n for w, n in want.items() if not w[-1])
    assert decontaminate.report(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.report(docs.where("false"), bench).count() == 0
    # Slices of the items' fingerprints change nothing.
    shape = decontaminate.item_windows(bench)
    rows_of = lambda size: sorted(map(str, decontaminate.hits(docs, shape, size).collect()))
    assert rows_of(3) == rows_of(1 << 20)


def test_winnowing_keeps_a_gram_of_every_shared_span():
    rng = np.random.default_rng(0)
    for span in (1, 2, 3, 7, 10):
        shared = rng.integers(0, 2**63, span).astype(np.uint64)
        for _ in range(50):
            sides = []
            for _ in range(2):
                ends = [rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64) for _ in range(2)]
                row = np.concatenate((ends[0], shared, ends[1]))
                sides.append(set(decontaminate.winnow(row, np.array([0, len(row)]), span)[1].tolist()))
            assert sides[0] & sides[1]


@pytest.mark.parametrize("name", ["op1_tokens", "op2_urls", "op5_quality", "op6_simhash"])
def test_queries_return_every_row(spark, name):
    rows = table(spark, "pages" if name == "op2_urls" else "documents").count()
    assert QUERIES[name](spark, SF_DIR).count() == rows
