"""Operator 3: shards of near-equal bytes by histogram sort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvewright.llm.common import checkpointed, query, stored, table

_LOWEST = -(2**63)
_KEY, _TIE, _COPY, _SIZE = "__shard_key", "__shard_tie", "__shard_copy", "__shard_size"
_PARTS = (_KEY, _TIE, _COPY)


@dataclass(frozen=True)
class _Bracket:
    """Keys that may hold a boundary: all of ``low..high`` of the key part after ``at``."""

    at: tuple[int, ...]  # the single value of each earlier part
    low: int
    high: int
    below: int  # bytes of all smaller keys

    @property
    def part(self) -> str:
        return _PARTS[len(self.at)]

    def holds(self) -> Column:
        inside = F.col(self.part).between(self.low, self.high)
        for part, value in zip(_PARTS, self.at, strict=False):
            inside = (F.col(part) == value) & inside
        return inside

    def bin(self, probes: int) -> Column:
        width = (self.high - self.low) // probes + 1
        offset = F.col(self.part).cast("decimal(20,0)") - F.lit(str(self.low)).cast("decimal(20,0)")
        return F.floor(offset / F.lit(str(width)).cast("decimal(20,0)")).cast("int")

    def edge(self, value: int) -> tuple[int, ...]:
        """The boundary just before ``value`` of this part."""
        whole = (*self.at, value) if value < 2**63 else (*self.at[:-1], self.at[-1] + 1)
        return whole + (_LOWEST,) * (len(_PARTS) - len(whole))


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the sort key and the byte size of each row.

    The key is a 63-bit hash of the text, so the order is random but copies lie
    side by side; doc_id decides inside equal texts, and a hash of the row's place
    in the table among rows equal in both. A null text counts no bytes; a null
    doc_id sorts first.
    """
    return docs.withColumns(
        {
            _KEY: F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 1),
            _TIE: F.coalesce(F.col(doc_id).cast("long"), F.lit(_LOWEST)),
            _COPY: F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 33),
            _SIZE: F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8,
        }
    )


def boundaries(
    keys: DataFrame, shards: int, tolerance: float = 0.001, probes: int = 4096
) -> list[tuple[int, ...]]:
    """The ``shards - 1`` keys at which equal-byte shards begin.

    Each round counts, over all partitions at once, the exact bytes between
    ``probes`` candidate boundaries (a grouped sum: the driver sees one row per
    probe interval, never rows of the table) and keeps, for every boundary, the
    one interval its target falls in. Intervals are refined until they hold at
    most ``tolerance`` of a shard's bytes or one key; then the nearer edge is
    taken. A hash of the text that many rows share is refined by doc_id, and rows
    equal in both by their place.
    """
    first = keys.agg(F.sum(_SIZE), F.min(_KEY), F.max(_KEY)).first()
    if shards < 2 or first[0] is None:
        return []
    total = int(first[0])
    small = total / shards * tolerance
    found: dict[int, tuple[int, ...]] = {}
    active = {_Bracket((), first[1], first[2], 0): list(range(1, shards))}
    while active:
        brackets = list(active)
        per = max(16, probes // len(brackets))
        which, cell = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, bracket in enumerate(brackets):
            which = F.when(bracket.holds(), i).otherwise(which)
        tagged = keys.withColumn("w", which).where("w is not null")
        for i, bracket in enumerate(brackets):
            cell = F.when(F.col("w") == i, bracket.bin(per)).otherwise(cell)
        counted = (
            tagged.groupBy("w", cell.alias("cell"))
            .agg(
                F.sum(_SIZE).alias("bytes"), F.count(F.lit(1)).alias("rows"),
                *[F.min(part).alias(f"low{i}") for i, part in enumerate(_PARTS)],
                *[F.max(part).alias(f"high{i}") for i, part in enumerate(_PARTS)],
            )
            .orderBy("w", "cell")
            .collect()
        )
        refined: dict[_Bracket, list[int]] = {}
        for i, bracket in enumerate(brackets):
            below, cells = bracket.below, []
            for row in (r for r in counted if r["w"] == i):
                cells.append((below, row))
                below += row["bytes"]
            for split in active[bracket]:
                target = total * split / shards
                start, row = next(c for c in reversed(cells) if c[0] <= target)
                spans = [(row[f"low{n}"], row[f"high{n}"]) for n in range(len(_PARTS))]
                level = len(bracket.at)
                low, high = spans[level]
                # The part that tells the interval's rows apart; none if they are equal in all.
                apart = next((n for n in range(level, len(_PARTS)) if spans[n][0] < spans[n][1]), None)
                if apart is None or row["bytes"] <= small:
                    after = target - start > row["bytes"] / 2
                    found[split] = bracket.edge(high + 1 if after else low)
                else:
                    at = tuple(span[0] for span in spans[:apart]) if apart > level else bracket.at
                    refined.setdefault(_Bracket(at, *spans[apart], start), []).append(split)
        active = refined
    return [found[i] for i in range(1, shards)]


def shard_of(splitters: list[tuple[int, ...]]) -> Column:
    """The shard of a keyed row: the number of boundaries not above its key."""
    reached = F.lit(0)
    for splitter in splitters:
        above = F.col(_PARTS[-1]) >= splitter[-1]
        for part, value in reversed(list(zip(_PARTS[:-1], splitter, strict=False))):
            above = (F.col(part) > value) | ((F.col(part) == value) & above)
        reached = reached + above.cast("int")
    return reached


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.001) -> DataFrame:
    """``docs`` with ``shard`` (near-equal bytes) and ``slot`` (gapless in it).

    Nulls: a null text has size 8 and the key of an empty one, a null doc_id
    sorts first. Ties: identical rows take consecutive slots in any order and are
    cut like others where a boundary falls among them. A very long text is one
    row of its size. An empty table gives an empty result. Columns named shard or slot are
    replaced.

    The rows move once, range-partitioned by (shard, key, doc_id), so a group
    of copies spreads over tasks. Slots are positions inside those partitions
    plus a prefix sum over partition counts; the offsets, one row per partition
    and shard, are the only broadcast.
    """
    docs = docs.drop("shard", "slot")
    columns = docs.columns
    keys = checkpointed(keyed(docs).select(*_PARTS, _SIZE))
    splitters = boundaries(keys, shards, tolerance)
    return _slotted(keyed(docs), splitters, columns)


def _slotted(rows: DataFrame, splitters: list[tuple[int, ...]], columns: list[str]) -> DataFrame:
    order = ("shard", *_PARTS)
    ranged = stored(
        rows.withColumn("shard", shard_of(splitters))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}),
        "ranged",
    )
    parts = ranged.groupBy("shard", "__part").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first")
    )
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "shard", "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__offset")
    )
    return ranged.join(F.broadcast(offsets), ["shard", "__part"]).select(
        *[F.col(f"`{c}`") for c in columns], "shard", (F.col("__row") + F.col("__offset")).alias("slot")
    )


@query("op3_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 shards; law ``bytes``.

    The keys and digests are written once; the rounds of counting and the
    exchange read those narrow rows only.
    """
    docs = keyed(table(spark, sf_dir, "documents"))
    narrow = checkpointed(
        docs.select(
            "doc_id",
            F.col(_SIZE).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
            *_PARTS, _SIZE,
        )
    )
    placed = _slotted(narrow, boundaries(narrow, 24), ["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
