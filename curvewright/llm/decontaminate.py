"""Operator 7: benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvewright.llm.common import ascii_lower, bounded, query, raw_bytes, stored, table, text_map

#: Words in a window; a shorter item is one window.
SPAN = 10
#: Bytes of text whose words are found at once.
_STEP = 1 << 20
#: Most fingerprints of items that are looked up in one pass over the texts.
SLICE = 1 << 20
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_spans(chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes, and for each row its first word's index."""
    if not len(chars):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    inside = _IS_WORD[chars]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    rows = ends[:-1][ends[:-1] < len(chars)]
    opens[rows] |= inside[rows]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = rows[rows > 0] - 1
    closes[last] |= inside[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, ends)


def word_hashes(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each lower-cased word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    span = chars[starts[0] : ends[-1]]
    first = starts - starts[0]
    place = np.arange(len(span)) - np.repeat(first, np.diff(np.append(first, len(span))))
    powers = np.cumprod(np.full(int(place.max()) + 1, _P))
    values = np.where(_IS_WORD[span], (_LOWER[span] + np.uint64(1)) * powers[place], np.uint64(0))
    return _mixed(np.add.reduceat(values, first))


def winnow(hashes: np.ndarray, firsts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams kept, for rows of words ``firsts[i]..firsts[i+1]``.

    k is half of ``span`` rounded up; of every ``span - k + 1`` consecutive
    k-grams the smallest hash is kept (the last of equal ones), so any ``span``
    words shared by two texts keep one k-gram in common.
    """
    k = (span + 1) // 2
    width = span - k + 1
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        grams = grams * _Q + hashes[j : j + len(grams)]
    grams = _mixed(grams)
    best, least = np.arange(n), grams[:n].copy()
    for j in range(1, width):
        other = grams[j : j + n]
        better = other <= least
        best[better] = (np.arange(n) + j)[better]
        np.minimum(least, other, out=least)
    row = np.searchsorted(firsts, np.arange(n), side="right") - 1
    whole = np.arange(n) + span <= firsts[row + 1]
    kept = np.unique(best[whole])
    return kept, grams[kept]


def _pieces(ends: np.ndarray):
    """Runs of rows of about ``_STEP`` bytes; a longer row is a run of its own."""
    at = 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _STEP, side="right")) - 1)
        yield at, to
        at = to


def _kept(column: pa.Array, spans: list[int]):
    """For each run of rows of a batch: its words and the k-grams kept for each span."""
    chars, ends = raw_bytes(column)
    for at, to in _pieces(ends):
        own = chars[ends[at] : ends[to]]
        starts, stops, firsts = word_spans(own, ends[at : to + 1] - ends[at])
        hashes = word_hashes(own, starts, stops)
        yield at, own, starts, stops, firsts, [(span, *winnow(hashes, firsts, span)) for span in spans]


def fingerprints(texts: DataFrame, spans: list[int]) -> DataFrame:
    """(span, gram): the distinct fingerprints of ``text``."""

    def run(batches):
        for batch in batches:
            for *_, kept in _kept(batch.column(0), spans):
                for span, _, grams in kept:
                    own = np.unique(grams.view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), span, np.int32)), pa.array(own)], names=["span", "gram"]
                    )

    return bounded(texts.select("text")).mapInArrow(run, "span int, gram long").distinct()


def candidates(texts: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """(key, span, start, window): the windows of ``text`` that cover a known fingerprint.

    ``texts`` has key and text; ``known`` the sorted fingerprints of each span.
    """
    lookup = texts.sparkSession.sparkContext.broadcast(known)
    names = ["key", "span", "start", "window"]

    def run(batches):
        known = lookup.value
        for batch in batches:
            rows, kinds, places, windows = [], [], [], []
            for at, own, starts, stops, firsts, kept in _kept(batch.column(1), list(known)):
                for span, position, grams in kept:
                    there = np.searchsorted(known[span], grams)
                    hit = known[span][np.minimum(there, len(known[span]) - 1)] == grams
                    back = np.arange(span - (span + 1) // 2 + 1)
                    first = np.unique(position[hit][:, None] - back)
                    first = first[first >= 0]
                    row = np.searchsorted(firsts, first, side="right") - 1
                    whole = first + span <= firsts[row + 1]
                    first, row = first[whole], row[whole]
                    rows += (row + at).tolist()
                    kinds += [span] * len(row)
                    places += (first - firsts[row]).tolist()
                    windows += [
                        b" ".join(own[a:b].tobytes() for a, b in zip(starts[f : f + span], stops[f : f + span], strict=True))
                        .lower().decode()
                        for f in first.tolist()
                    ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(kinds, pa.int32()),
                        pa.array(places, pa.int32()),
                        pa.array(windows, pa.string()),
                    ],
                    names=names,
                )

    sent = bounded(texts.select("key", "text"))
    return sent.mapInArrow(run, "key binary, span int, start int, window string").distinct()


def word_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` plus ``n_words`` of each text."""

    def work(column: pa.Array) -> list[pa.Array]:
        chars, ends = raw_bytes(column)
        counts = [np.diff(word_spans(chars[ends[a] : ends[b]], ends[a : b + 1] - ends[a])[2]) for a, b in _pieces(ends)]
        return [pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())]

    return text_map(docs, "text", keep, "n_words long", work)


def text_key(text: str = "text"):
    """What names a text in 16 bytes: equal texts share it, others do not but for an MD5 collision."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _windows(texts: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` plus (span, window) of every window of the items' texts."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(_WORDS), F.lit(0))
    span = F.least(F.size("w"), F.lit(SPAN))
    return (
        texts.select(*keep, words.alias("w"))
        .where(F.size("w") > 0)
        .select(*keep, "w", span.alias("span"), F.explode(F.sequence(F.lit(1), F.size("w") - span + 1)).alias("at"))
        .select(*keep, "span", F.array_join(F.slice("w", F.col("at"), F.col("span")), " ").alias("window"))
    )


def hits(docs: DataFrame, windows: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """(key, span, start, window): where the texts of ``docs`` hold one of ``windows``.

    ``docs`` has ``text``; ``key`` is ``text_key``. The k-grams kept of both
    sides meet by hash: those of the items in slices of at most ``slice_size``,
    each sent to every task and looked up in one pass over the texts, so what is
    broadcast is bounded however large the benchmark is, and texts never move.
    A k-gram found is extended to every window that covers it, and these are
    joined to the items' windows word for word. A row is a place in a text,
    never a pair with an item, so a passage that many items or documents share
    stays linear; copies of a text are one.
    """
    spans = sorted(r["span"] for r in windows.select("span").distinct().collect())  # at most SPAN values
    spark = docs.sparkSession
    shape = "key binary, span int, start int, window string"
    if not spans:
        return spark.createDataFrame([], shape)
    grams = stored(fingerprints(windows.select(F.col("window").alias("text")), spans), "bench-grams")
    slices = -(-grams.count() // slice_size)
    keyed = docs.select(text_key().alias("key"), "text")
    found = spark.createDataFrame([], shape)
    for part in range(slices):
        known: dict[int, list[int]] = {}
        for row in grams.where(F.pmod(F.xxhash64("gram"), F.lit(slices)) == part).toLocalIterator():
            known.setdefault(row["span"], []).append(row["gram"])
        places = candidates(keyed, {s: np.sort(np.array(v).view(np.uint64)) for s, v in known.items()})
        exact = places.join(windows.select("span", "window").distinct(), ["span", "window"], "left_semi")
        found = found.unionByName(exact)
    return stored(found.distinct() if slices > 1 else found, "hits")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, span, window): the windows of every item, written once."""
    return stored(_windows(benchmark, ["item_id"]).distinct(), "bench-windows")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, n_hit, n_items, items_sha256) of the texts of ``docs`` that hold a window."""
    windows = item_windows(benchmark)
    found = hits(docs, windows)
    order = Window.partitionBy("key").orderBy("start", "span").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("span")
    covered = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(order), F.lit(0))))
    marked = found.withColumn("new", covered).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    items = (
        found.select("key", "span", "window").distinct()
        .join(windows, ["span", "window"])
        .groupBy("key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
        .select(
            "key",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
    )
    return stored(marked.join(items, "key"), "contaminated")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): words, hit words, items.

    A null or empty text has no words; items without words have no window; an
    item without id marks words but is not listed; repeated items count once,
    repeated documents are each returned. Empty tables on either side give no
    hits. Other columns are not read.
    """
    found = contaminated_texts(docs, benchmark)
    counted = word_counts(docs.select("doc_id", "text", text_key().alias("key")), ["doc_id", "key"])
    return counted.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS t, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ts AS (SELECT DISTINCT t FROM bw),
dw AS (
  SELECT r, t, i, array_to_string(w[i:i + t - 1], ' ') AS g
  FROM (SELECT r, w, t, unnest(range(1, len(w) - t + 2)) AS i FROM d, ts WHERE len(w) >= t)),
m AS (SELECT DISTINCT dw.r, dw.t, dw.i, bw.item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.g = bw.g),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + t)) AS p FROM m) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS x
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(x, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, all columns kept."""
    found = stored(hits(docs.select("text"), item_windows(benchmark)).select("key").distinct(), "contaminated")
    return docs.join(found, text_key() == found["key"], "left_anti")


@query("op7_decontaminate", ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
