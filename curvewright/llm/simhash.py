"""Operator 6: SimHash near copies by tiled exact comparison."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.llm.common import checkpointed, components, query, stored, table, text_map

RADIUS = 3
#: Most fingerprints in a tile; population-count classes above it get several tiles.
TILE = 4096
#: Shingles whose bits are counted at once.
_STEP = 1 << 17


def shingle_hashes(text: bytes, k: int) -> list[int]:
    """XXH64 (seed 42) of every ``k``-word shingle; of the whole sequence if shorter."""
    words = text.lower().split()  # bytes: A-Z only, x20 and x09 to x0D only
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -k] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)]


def _fold(hashes: list[int], counts: list[int]) -> list[np.ndarray]:
    """Fingerprints of documents that have ``counts[i]`` of the hashes each."""
    if not counts:
        return []
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    most = (2 * sums > np.array(counts)[:, None]).astype(np.uint8)
    return list(np.packbits(most, axis=1, bitorder="little").view("<u8")[:, 0])


def fingerprints_of(texts: list[str | None], k: int = 3) -> np.ndarray:
    """SimHash of each text as a signed 64-bit number; zero without words."""
    made = np.zeros(len(texts), np.uint64)
    hashes: list[int] = []
    counts: list[int] = []
    rows: list[int] = []

    def flush():
        for row, value in zip(rows, _fold(hashes, counts), strict=True):
            made[row] = value
        hashes.clear(), counts.clear(), rows.clear()

    for i, text in enumerate(texts):
        own = shingle_hashes((text or "").encode(), k)
        if own:
            hashes += own
            counts.append(len(own))
            rows.append(i)
        if len(hashes) > _STEP:
            flush()
    flush()
    return made.view(np.int64)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", k: int = 3) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus ``fp`` of the whole text (null: zero)."""
    return text_map(
        docs, text, keep, "fp long", lambda c: [pa.array(fingerprints_of(c.to_pylist(), k), pa.int64())]
    )


def _links(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius, or as many of them as connect the same fingerprints."""
    step = max(1, (1 << 21) // len(right))
    a, b = [], []
    for s in range(0, len(left), step):
        # As unsigned numbers: the bit count of a negative one is that of its absolute value.
        near = np.bitwise_count((left[s : s + step, None] ^ right[None, :]).view(np.uint64)) <= radius
        i, j = np.nonzero(near)
        if same:
            i, j = i[i + s < j], j[i + s < j]
        a.append(i + s)
        b.append(j)
    i, j = np.concatenate(a), np.concatenate(b)
    if len(i) <= len(left) + len(right):
        return i, j
    # A dense group: keep a link only where it joins two parts that nothing joined before.
    part = np.arange(len(left) + len(right)) if not same else np.arange(len(left))
    shift = 0 if same else len(left)
    kept_i, kept_j = [], []
    bounds = np.flatnonzero(np.diff(i)) + 1
    for row, js in zip(i[np.concatenate(([0], bounds))], np.split(j, bounds), strict=True):
        parts, first = np.unique(part[js + shift], return_index=True)
        new = parts != part[row]
        if new.any():
            kept_i += [row] * int(new.sum())
            kept_j += js[first[new]].tolist()
            part[np.isin(part, parts)] = part[row]
    return np.array(kept_i), np.array(kept_j)


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Half of the steps between classes whose counts differ by no more than the radius."""
    steps = product(range(-radius, radius + 1), repeat=4)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): pairs of the distinct ``fp`` values that connect all pairs within the radius.

    Fingerprints are classed by the population counts of their four 16-bit
    quarters. Two of them differ in at least as many bits as their counts
    differ in sum, so a pair of classes beyond the radius is skipped whole: of
    random fingerprints about one pair in 26 is left, and each class meets at
    most 129 others. A class is cut into tiles of at most ``tile`` members, so
    a task holds two tiles, however many documents share a class. Tile pairs
    are compared exactly with exclusive-or and bit counts.

    The class table has at most 17**4 rows whatever the input: that bounds the
    broadcasts here.
    """
    masks = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    classed = prints.select("fp", *[m.alias(f"p{i}") for i, m in enumerate(masks)])
    quarter = [f"p{i}" for i in range(4)]
    sizes = checkpointed(
        classed.groupBy(*quarter).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    )
    tiles = (
        classed.join(F.broadcast(sizes), quarter)
        .groupBy(*quarter, F.pmod(F.xxhash64("fp"), F.col("tiles")).alias("t"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = checkpointed(tiles)
    steps = F.array(*[F.struct(*[F.lit(v).alias(f"s{i}") for i, v in enumerate(s)]) for s in _offsets(radius)])
    other = sizes.select(*[F.col(q).alias(f"o{q}") for q in quarter], F.col("tiles").alias("otiles"))
    near = (
        sizes.select(*quarter, F.explode(steps).alias("s"))
        .select(*quarter, *[(F.col(f"p{i}") + F.col(f"s.s{i}")).alias(f"op{i}") for i in range(4)])
        .join(F.broadcast(other), [f"op{i}" for i in range(4)])
    )
    same = F.lit(True)
    for i in range(4):
        same = same & (F.col(f"p{i}") == F.col(f"op{i}"))
    left = tiles.select(*quarter, "t", F.col("fps").alias("left"))
    right = tiles.select(*[F.col(q).alias(f"o{q}") for q in quarter], F.col("t").alias("ot"), F.col("fps").alias("right"))
    pairs = (
        left.join(near, quarter)
        .withColumn("ot", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("otiles") - 1).cast("long"))))
        .withColumn("same", same & (F.col("t") == F.col("ot")))
        .where(F.col("same") | ~same | (F.col("t") < F.col("ot")))
        .join(right, [*[f"op{i}" for i in range(4)], "ot"])
        .select("left", "right", "same")
    )

    def compare(batches):
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            sides = []
            for name in ("left", "right"):
                column = batch.column(batch.schema.get_field_index(name))
                sides.append((column.values.to_numpy(), column.offsets.to_numpy()))
            (lv, lo), (rv, ro) = sides
            for n, alike in enumerate(batch.column(2).to_pylist()):
                a, b = lv[lo[n] : lo[n + 1]], rv[ro[n] : ro[n + 1]]
                i, j = _links(a, b, alike, radius)
                if len(i):
                    found.append(np.stack((a[i], b[j])))
            a, b = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def group_labels(printed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id): the smallest doc_id reachable from each fingerprint of ``printed``."""
    prints = checkpointed(printed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(prints, radius)).withColumnRenamed("node", "fp")
    lowest = joined.join(prints, "fp").groupBy("component").agg(F.min("least").alias("lowest"))
    named = joined.join(lowest, "component").select("fp", "lowest", "component")
    # Written, so that the join with a common fingerprint's rows can be split.
    return stored(
        prints.join(named, "fp", "left").select(
            "fp",
            F.coalesce("lowest", "least").alias("component_id"),
            F.coalesce("component", "fp").alias("component"),
        ),
        "components",
    )


def near_copies(docs: DataFrame, k: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs`` (doc_id, text).

    Texts without words (null, empty) have the fingerprint zero and are linked
    like any other; repeated rows are all returned; null doc_ids take part but
    are never a component's name unless it has no other (then null). An empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    printed = checkpointed(fingerprints(docs, ["doc_id"], k=k))
    return printed.join(group_labels(printed, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their SimHash component."""
    return near_copies(table(spark, sf_dir, "documents"))
