"""Operator 10: secrets by pattern and by sliding-window entropy."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.llm.common import query, table

#: The base kinds in listed order: pattern, and least length of its last group.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]+", 20),
    ("hex", r"[0-9a-f]+", 24),
)

#: Items of a list that are worked off together; see _scanned.
BLOCK = 256
#: A candidate string, and the characters in a window of it.
CANDIDATE, WINDOW = r"[A-Za-z0-9+/_=-]{20,}", 20
#: Character classes of candidates, the narrowest first, and the bits per character from
#: which a window of a candidate of that class counts as random. A window of 20
#: characters has at most log2(20) = 4.32 bits.
CLASSES = (
    ("digits", r"^[0-9]+$", None),  # numbers are not secrets by themselves
    ("one case", r"^([a-z/_=-]+|[A-Z/_=-]+)$", None),  # nor are names and paths in one case
    ("letters", r"^[A-Za-z/_=-]+$", 4.0),  # random letters mix cases more evenly than names do
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("alphanumeric", r"^[A-Za-z0-9]+$", 3.6),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.8),
)
#: Known not to be secrets (lower case): a window that touches one is not looked at.
ALLOWED = ("example", "placeholder", "changeme", "xxxx", "0123456789", "abcdefgh", "your_", "your-", "test_", "dummy")


def _lengths(parts: Column) -> Column:
    return F.transform(parts, lambda x: F.length(x).cast("long"))


def _spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, match, group 2), in code points.

    The text between matches comes from ``split`` by the same pattern, so a
    match starts where the pieces and matches before it end.
    """
    groups = 2 if pattern.count("(") - pattern.count("(?") >= 2 else 0
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(groups))
    gaps = F.split(text, pattern, -1)
    found = F.arrays_zip(
        _lengths(F.slice(gaps, F.lit(1), F.size(matches))).alias("gap"), matches.alias("match"), values.alias("value")
    )
    def place(at: Column, x: Column) -> tuple[Column, Column]:
        begin = at + x["gap"]
        end = begin + F.length(x["match"])
        return end, F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("match"), x["value"].alias("value"))

    return _scanned(found, "struct<start:bigint,end:bigint,match:string,value:string>", place)


def _scanned(items: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """One output per item, each from the item and a number carried along: ``step`` gives both anew.

    Appending copies a list, so short lists are filled and then listed themselves.
    """

    def one(state: Column, x: Column) -> Column:
        carried, made = step(state["at"], x)
        return F.struct(carried.alias("at"), F.concat(state["made"], F.array(made)).alias("made"))

    def block(state: Column, part: Column) -> Column:
        inner = F.struct(state["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("made"))
        return _bound(
            F.aggregate(part, inner, one),
            lambda done: F.struct(done["at"].alias("at"), F.concat(state["lists"], F.array(done["made"])).alias("lists")),
        )

    def all_blocks(whole: Column) -> Column:
        last = F.floor((F.size(whole) - 1) / BLOCK).cast("int")
        parts = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(whole, b * BLOCK + 1, F.lit(BLOCK)))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{kind}>>").alias("lists"))
        return F.aggregate(parts, start, block, lambda s: F.flatten(s["lists"]))

    return _bound(items, all_blocks)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def peak_entropy(word: Column, width: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits a character, of any ``width`` characters in a row.

    The window slides: one character enters, one leaves, and the sum of c log2 c
    over its counts c changes by the two differences of their counts, which are
    counted among the window's characters. A step costs the width, not the length
    of the word; the characters are split once.
    """
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(width + 2)])
    term = lambda c: F.element_at(terms, c + 1)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(1e9).alias("least"))

    def least(chars: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            entering = F.element_at(chars, i)
            first = F.greatest(i - width, F.lit(1))
            before = F.slice(chars, first, F.least(i - 1, F.lit(width)))
            times = F.size(F.filter(before, lambda c: c == entering))
            grown = state["sum"] + term(times + 1) - term(times)
            # The window is one too wide now: its first character leaves.
            leaving = F.element_at(chars, first)
            held = F.size(F.filter(before, lambda c: c == leaving)) + (leaving == entering).cast("int")
            total = F.when(i > width, grown + term(held - 1) - term(held)).otherwise(grown)
            full = F.when(i >= width, F.least(state["least"], total)).otherwise(state["least"])
            return F.struct(total.alias("sum"), full.alias("least"))

        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda s: s["least"])

    chars = F.transform(F.split(word, ""), lambda c: F.ascii(c))
    return F.lit(math.log2(width)) - _bound(chars, least) / width


def _flagged(word: Column) -> Column:
    """Whether a stretch of a candidate between words of the allow list is random enough for its class."""

    def random(part: Column) -> Column:
        limit = F.lit(None).cast("double")
        for _, pattern, bits in reversed(CLASSES):
            limit = F.when(part.rlike(pattern), F.lit(bits).cast("double")).otherwise(limit)
        return F.when((F.length(part) >= WINDOW) & limit.isNotNull(), peak_entropy(part) >= limit).otherwise(False)

    return F.exists(F.split(word, "(?i)" + "|".join(ALLOWED), -1), random)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def _base_spans(text: Column, kind: str, place: int, pattern: str, least: int) -> Column:
    found = F.filter(_spans(text, pattern), lambda x: F.length(x["value"]) >= least)
    return F.transform(found, lambda x: _span(kind, place, x))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with what was found in the whole text.

    n_assign, n_access and n_hex count the base kinds; base_sha256 is of their
    spans; spans lists all, the method's own kind ``entropy`` last among equal
    starts. An entropy span inside a base span is the same find and is not
    repeated. A null text is empty; a text without finds has empty lists;
    repeated rows are all returned; other columns are not read. No shuffle:
    every row is decided where it is read, and the slow steps run only on
    candidate strings, of which ordinary text has few.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>")
    columns = {}
    for place, (kind, pattern, least) in enumerate(BASE):
        # A cheap test first: most texts hold none of the patterns.
        here = F.col("t").rlike(pattern if kind != "hex" else r"[0-9a-f]{24}")
        columns[kind] = F.when(here, _base_spans(F.col("t"), kind, place, pattern, least)).otherwise(none)
    base = docs.select("doc_id", text.alias("t")).withColumns(columns)
    base = base.withColumn("base", F.array_sort(F.concat(*[F.col(k) for k, _, _ in BASE])))
    # In order of starts, a candidate lies in a base span if one so far ends at or after its end.
    both = F.array_sort(
        F.concat(
            F.transform("base", lambda x: _ordered(x["start"], 0, x["end"], F.lit(""))),
            F.transform(_spans(F.col("t"), CANDIDATE), lambda x: _ordered(x["start"], 1, x["end"], x["value"])),
        )
    )

    def reach(furthest: Column, x: Column) -> tuple[Column, Column]:
        is_base = x["second"] == 0
        outside = F.when(~is_base & (furthest < x["end"]), x)
        return F.when(is_base, F.greatest(furthest, x["end"])).otherwise(furthest), outside

    candidates = F.filter(_scanned(both, _ORDERED, reach), lambda x: x.isNotNull() & _flagged(x["value"]))
    found = F.transform(candidates, lambda x: _span("entropy", len(BASE), x))
    base = base.withColumn("entropy", F.when(F.col("t").rlike(CANDIDATE), found).otherwise(none))
    return base.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind, _, _ in BASE],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "entropy"))).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )


_ORDERED = "struct<start:bigint,second:int,end:bigint,value:string>"


def _ordered(start: Column, second: int, end: Column, value: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(second).alias("second"), end.alias("end"), value.alias("value"))


def _span(kind: str, place: int, x: Column) -> Column:
    return F.struct(
        x["start"].alias("start"), F.lit(place).alias("place"), x["end"].alias("end"), F.lit(kind).alias("kind")
    )


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scanned for secrets."""
    return scan(table(spark, sf_dir, "documents"))
