"""Operator 5: a quality classifier of histogram gradient-boosted trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.llm.common import query, table, text_map

#: Most labelled documents the trees are fitted on: the first in order of a hash of doc_id.
SAMPLE = 20_000

FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "lower", "digit", "space", "punctuation", "symbol",
    "beyond_ascii", "newline", "exclaim", "distinct_words", "distinct_lines", "longest_word", "byte_entropy",
    "top_word", "symbol_words", "upper_words", "end_marks", "words_per_line", "top_byte",
)

_CLASS = np.full(256, 8)  # the rest: controls
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 6
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_ONE_HOT = np.eye(9)[_CLASS]
_MARKS = bytes(c for c in range(256) if _CLASS[c] == 5)


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; all zero where there is no text."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(float)
    upper, lower, digit, space, point, symbol, beyond, _, _ = (counts @ _ONE_HOT / n).tolist()
    share = counts[counts > 0] / n
    words = data.split()
    lines = [x for x in data.split(b"\n") if x]
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    m = max(1, len(words))
    # Distinct words as a share of what a text of this length would have, by a power law.
    return [
        np.log1p(n), np.log1p(len(words)), (n - space * n) / m, upper, lower, digit, space, point, symbol, beyond,
        counts[10] / n, counts[33] / n, len(seen) / m**0.8, len(set(lines)) / max(1, len(lines)),
        min(200, max(map(len, words), default=0)), float(-(share * np.log2(share)).sum()),
        max(seen.values(), default=0) / m,
        sum(c for w, c in seen.items() if w[-1] in _MARKS) / m,
        sum(c for w, c in seen.items() if w.isupper() and len(w) > 1) / m,
        (counts[46] + counts[33] + counts[63]) / m, np.log1p(len(words) / max(1, len(lines))), counts.max() / n,
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(-1, len(FEATURES))


@dataclass
class Trees:
    """Boosted trees as flat arrays: one row per tree, children of i at 2i+1 and 2i+2."""

    feature: np.ndarray  # int, trees x inner nodes
    threshold: np.ndarray  # float; a value at or below goes left
    leaf: np.ndarray  # float, trees x leaves
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: all rows and trees go down a level at once."""
        total = np.full(len(x), self.base)
        if self.leaf.size:
            depth = int(np.log2(self.leaf.shape[1]))
            tree = np.arange(len(self.leaf))[None, :]
            for s in range(0, len(x), 4096):
                part = x[s : s + 4096]
                node = np.zeros((len(part), len(self.leaf)), int)
                for _ in range(depth):
                    value = np.take_along_axis(part, self.feature[tree, node], axis=1)
                    node = 2 * node + 1 + (value > self.threshold[tree, node])
                total[s : s + 4096] += self.leaf[tree, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2,
    smooth: float = 2.0, least: float = 3.0,
) -> Trees:
    """Newton boosting on the logistic loss, over histograms of ``bins`` quantile bins.

    Without rows the score is one half; with one class only, its share.
    """
    n, d = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), int)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if n == 0 or y.min() == y.max():
        return Trees(feature, threshold, leaf, base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    flat = binned + np.arange(d) * bins
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(n, int)
        for level in range(depth):
            width = 2**level
            start = width - 1
            cell = ((node - start)[:, None] * (d * bins) + flat).ravel()
            g, h = (
                np.bincount(cell, np.repeat(v, d), width * d * bins).reshape(width, d, bins) for v in (gradient, hessian)
            )
            gl, hl = g.cumsum(2), h.cumsum(2)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for i, b in enumerate(best):
                j, c = divmod(int(b), bins)
                if gain[i, j, c] > 1e-9 and c < len(cuts[j]):
                    feature[t, start + i], threshold[t, start + i] = j, cuts[j][c]
            go = x[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + go
        at = node - inner
        value = np.bincount(at, gradient, inner + 1) / (np.bincount(at, hessian, inner + 1) + smooth)
        leaf[t] = rate * value
        margin += leaf[t, at]
    return Trees(feature, threshold, leaf, base)


def held_out(doc_id):
    """True for the fold that no label is learned from: crc32 of doc_id as text, mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample`` labelled documents outside the held-out fold.

    Labels without a quality or a doc_id are not learned from; a doc_id that is
    labelled or stored more than once keeps the row that sorts first. The
    sample (doc_id and label) is bounded, and so is its broadcast.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    )
    measured = (
        text_map(
            rows, "text", ["doc_id", "quality"], "x array<double>",
            lambda c: [pa.array(list(matrix(c.to_pylist())), pa.list_(pa.float64()))],
        )
        .groupBy("doc_id")
        .agg(F.min(F.struct("quality", "x")).alias("r"))
        .orderBy("doc_id")
        .select("r.*")
        .collect()
    )
    x = np.array([r["x"] for r in measured], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["quality"] for r in measured], float))


def scored(docs: DataFrame, model: Trees, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` plus the score, from the whole text alone."""
    return text_map(
        docs, text, keep, f"{name} double",
        lambda c: [pa.array(model.scores(matrix(c.to_pylist())), pa.float64())],
    )


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Null and empty texts have all statistics zero and get what the trees say of
    that; null doc_ids are never held out; repeated rows are all returned; an
    empty label table gives the score one half, an empty docs table no rows.
    """
    model = train(docs, labels, sample)
    return scored(docs, model, ["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns kept."""
    marked = scored(docs, train(docs, labels, sample), docs.columns, name="__llm_score")
    return marked.where("__llm_score >= 0.5").select(*docs.columns)


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored for quality."""
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
