"""Inputs that every operator must stand: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, slot long, "
    "size long, fp long, key string, n long, h long, id long, component long, taken long, target double, r int, "
    "start int, window string, span int, label string, host string, __score int"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def words(rng: random.Random, n: int) -> str:
    syllables = "ka lo mi ren tas dor vel qui nes pra".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def edge_rows(seed: int = 3, plain: int = 30):
    """(doc_id, text, lang, source, n_chars) rows."""
    rng = random.Random(seed)
    base = words(rng, 80)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, None, 4),
        (None, words(rng, 30), "en", "b", 1),
        (4, "one", "en", None, 3),
        (5, base, "en", "a", 1),
        (5, base, "en", "a", 1),  # a repeated row
        (6, base, "en", "b", 1),  # a copy
        (7, base + " end", "en", "c", 1),  # a near copy
        (5, words(rng, 25), "en", "a", 1),  # an id used twice
        (8, words(rng, 40_000), "en", "a", 1),  # a very long text
        (9, "ÄÖ ß 日本語 🙂 Tok3n " * 4, "de", "é", 1),
        (-10, words(rng, 12).upper() + "!! $$$", "en", "c", 1),
    ]
    rows += [(100 + i, words(rng, rng.randint(5, 120)), "en", rng.choice("abc"), 1) for i in range(plain)]
    return rows


def edge_docs(spark, rows=None):
    """The rows as a table with further columns whose names an operator may use itself."""
    rest = (0.5, 1, 2, 3, 4, "k", 5, 6, 7, 8, 9, 1.5, 1, 2, "w", 3, "l", "h", 4)
    return spark.createDataFrame([(*r, *rest) for r in (edge_rows() if rows is None else rows)], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
