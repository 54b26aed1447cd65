"""Groups of similar documents: wide SimHash tiles find pairs, shingle sets decide.

The pipeline's form of operator 6. The 64-bit fingerprints of ``simhash`` link
only texts that differ in a few words in thousands; here two texts are linked if
the sets of their five-word shingles have a Jaccard similarity of 0.8 or more.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvewright.llm.common import checkpointed, components, stored, text_map

SHINGLE, SIMILAR = 5, 0.8
#: The 64-bit words of a fingerprint.
WORDS = ("w0", "w1", "w2", "w3")
#: Fingerprints of 256 bits within this many differing bits are compared as sets. At
#: similarity 0.8 a bit differs with probability 0.154 at most, 0.188 for sets below SMALL
#: shingles: 2.3e-5 of pairs at just 0.8 lie beyond the radius at most, and 3.0e-5 of
#: sets below SMALL. Unrelated sets fall within it with probability 8.7e-16 at most, and below SMALL
#: with 5.1e-9 at most (8 and 10 shingles, whose bits are mostly zero), so they join no groups.
RADIUS, SMALL, SMALL_RADIUS = 64, 64, 74
#: Most fingerprints of a tile, and most shingle sets of a block.
TILE, BLOCK = 1 << 15, 256
#: Rows of a tile that meet another tile at once: their pairs stay in a processor's cache.
STEP = 16


def shingle_set(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """The distinct ``k``-word shingles as rows of two 64-bit hashes, sorted."""
    words = text.lower().split()
    if not words:
        return np.zeros((0, 2), np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(k, len(words))
    starts = np.concatenate(([0], ends[:-k] + 1)).tolist()
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(joined[a:b]) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)])
    pairs = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return pairs[np.unique(pairs[:, 0], return_index=True)[1]]


def _long(names: tuple[str, ...]) -> str:
    return ", ".join(f"{name} long" for name in names)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Another 64 bits for each 64-bit hash: odd multipliers and shifted exclusive-ors."""
    for shift, factor in ((33, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def _print(pairs: np.ndarray) -> tuple[int, ...]:
    """Set hash, size and the words of the fingerprint."""
    n = len(pairs)
    if not n:
        return (0,) * (2 + len(WORDS))
    ones = np.zeros(64 * len(WORDS), np.int64)
    for s in range(0, n, 1 << 15):
        part = pairs[s : s + (1 << 15)]
        part = np.ascontiguousarray(np.hstack((part, _mixed(part)))).view(np.uint8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    words = np.packbits(2 * ones > n, bitorder="little").view("<u8").astype("<i8").tolist()
    whole = int(pairs.sum(axis=0, dtype=np.uint64).astype("<i8")[0])
    return whole, n, *words


def prints(docs: DataFrame, keep: list[str], k: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` plus id (of the shingle set), n (its size) and w0 to w3 (its fingerprint)."""

    def work(column: pa.Array) -> list[pa.Array]:
        made = [_print(shingle_set((t or "").encode(), k)) for t in column.to_pylist()]
        made = np.array(made, np.int64).reshape(-1, 2 + len(WORDS))
        return [pa.array(made[:, i]) for i in range(2 + len(WORDS))]

    return text_map(docs, "text", keep, "id long, n long, " + _long(WORDS), work)


def _merge(part: np.ndarray, i: int, js: np.ndarray) -> np.ndarray:
    """Those of ``js`` that join i to another part, one for each part; merges the parts."""
    parts, first = np.unique(part[js], return_index=True)
    new = parts != part[i]
    if new.any():
        part[np.isin(part, parts)] = part[i]
    return js[first[new]]


def _columns(group: pa.Table, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """id, n and words by size, equal sizes by id: the order does not depend on the arrival of rows."""
    ids, n, *words = (group[prefix + c].to_numpy() for c in ("id", "n", *WORDS))
    order = np.lexsort((ids, n))
    return ids[order], n[order], np.stack(words)[:, order].view(np.uint64)


def _near(an: np.ndarray, a: np.ndarray, bn: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """i, j and differing bits of the pairs that may be similar by size and fingerprint.

    The last word is compared only where the others leave the pair within the radius.
    Different sets of equal size share all but one shingle each at most, so below 9
    shingles they are never similar.
    """
    bits = np.bitwise_count(a[0][:, None] ^ b[0])  # three words: 192 bits, one byte
    for x, y in zip(a[1:-1], b[1:-1], strict=True):
        bits += np.bitwise_count(x[:, None] ^ y)
    i, j = np.divmod(np.flatnonzero(bits <= max(RADIUS, SMALL_RADIUS)), len(bn))
    bits = bits[i, j].astype(np.int16) + np.bitwise_count(a[-1, i] ^ b[-1, j])
    less, more = np.minimum(an[i], bn[j]), np.maximum(an[i], bn[j])
    same = less == more
    reach = np.where(less < SMALL, SMALL_RADIUS, RADIUS)
    keep = (bits <= reach) & (less - same >= SIMILAR * (more + same) - 1e-6)
    return i[keep], j[keep], bits[keep]


def _compare(a: pa.Table, b: pa.Table) -> pa.Table:
    """Links between the rows of two tiles, which may be one tile: equal rows then have equal numbers."""
    found = [np.zeros((2, 0), np.int64)]
    if len(a) and len(b):
        (ai, an, aw), (bi, bn, bw) = _columns(a), _columns(b, "r")
        same = len(ai) == len(bi) and bool((ai == bi).all())
        part = np.arange(len(ai) + len(bi)) if not same else np.arange(len(ai))
        shift = 0 if same else len(ai)
        for s in range(0, len(ai), STEP):
            rows = slice(s, s + STEP)
            lo = np.searchsorted(bn, an[rows][0] * SIMILAR - 1e-6)
            hi = np.searchsorted(bn, an[rows][-1] / SIMILAR + 1e-6, side="right")
            if lo >= hi:
                continue
            i, j, _ = _near(an[rows], aw[:, rows], bn[lo:hi], bw[:, lo:hi])
            i, j = i + s, j + lo
            keep = ai[i] != bi[j]
            i, j = i[keep], j[keep]
            cuts = np.flatnonzero(np.diff(i)) + 1
            for x, js in zip(i[np.append(0, cuts)] if len(i) else [], np.split(j, cuts), strict=False):
                new = _merge(part, x, js + shift) - shift
                if len(new):
                    found.append(np.stack((np.full(len(new), ai[x]), bi[new])))
    x, y = np.concatenate(found, axis=1)
    return pa.table({"a": x, "b": y})


def candidate_links(sets: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect all ``sets`` (id, n, w0 to w3) that may be similar.

    Similar sets differ in size by a factor of 0.8 at most, so sizes are cut
    into classes of that ratio, only equal and adjacent classes meet, and inside
    a pair of tiles rows meet the run of sizes in reach. Tiles are bounded;
    every pair of them is compared exactly with exclusive-or and bit counts, and
    of a dense group only as many links are kept as connect it.
    """
    step = math.log(1 / SIMILAR) * (1 + 1e-9)
    classed = sets.where("n > 0").withColumn("c", F.floor(F.log("n") / step).cast("int"))
    sizes = classed.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    sizes = checkpointed(sizes)  # one row per size class: a logarithm of the longest text
    classed = classed.join(F.broadcast(sizes), "c").withColumn("t", F.pmod(F.xxhash64("id"), "tiles"))
    tiles = sizes.select("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("t"))
    other = tiles.select(F.col("c").alias("oc"), F.col("t").alias("ot"))
    pairs = tiles.withColumn("oc", F.explode(F.array("c", F.col("c") + 1))).join(other, "oc")
    pairs = pairs.where((F.col("oc") > F.col("c")) | (F.col("ot") >= F.col("t"))).select("c", "t", "oc", "ot")
    pairs = checkpointed(pairs)
    fields = ["id", "n", *WORDS]
    left = classed.join(pairs, ["c", "t"]).select("c", "t", "oc", "ot", *fields)
    right = (
        classed.select(F.col("c").alias("oc"), F.col("t").alias("ot"), *fields)
        .join(pairs, ["oc", "ot"])
        .select(
            F.col("c").alias("rc"), F.col("t").alias("rt"), F.col("oc").alias("roc"), F.col("ot").alias("rot"),
            *[F.col(f).alias("r" + f) for f in fields],
        )
    )

    return (
        left.groupBy("c", "t", "oc", "ot")
        .cogroup(right.groupBy("rc", "rt", "roc", "rot"))
        .applyInArrow(_compare, "a long, b long")
    )


def similar_links(texts: DataFrame, groups: DataFrame, k: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(a, b): links of exact similarity that connect what is similar inside each group.

    ``texts`` has (id, text), ``groups`` (node, component). A group is cut into
    blocks of about ``block`` sets and every two blocks meet, so no task holds a
    whole group; small groups share tasks. Fingerprints within the radius are
    tried nearest first, and a pair already connected is not tried again.
    """
    members = texts.join(groups, texts["id"] == groups["node"]).select("id", "text", "component")

    def work(column: pa.Array) -> list[pa.Array]:
        sets = [shingle_set((t or "").encode(), k) for t in column.to_pylist()]
        made = np.array([_print(s) for s in sets], np.int64).reshape(-1, 2 + len(WORDS))
        lists = pa.array([s[:, 0].astype("<i8") for s in sets], pa.list_(pa.int64()))
        return [*(pa.array(made[:, i]) for i in range(1, 2 + len(WORDS))), lists]

    added = f"n long, {_long(WORDS)}, s array<long>"
    sets = stored(text_map(members, "text", ["id", "component"], added, work), "sets")
    sizes = sets.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    cut = sets.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    shared = max(1, sets.count() // (2 * block))
    meets = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")),
    )
    alone = F.col("blocks") == 1
    placed = cut.withColumn("m", F.explode(meets)).select(
        "component", "id", "n", *WORDS, "s",
        F.when(alone, F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(F.col("component")).alias("g"),
        F.when(alone, -1).otherwise(F.col("m.i")).alias("i"),
        F.when(alone, -1).otherwise(F.col("m.j")).alias("j"),
    )

    def verify(group: pa.Table) -> pa.Table:
        comp, ids, n, *words = (group[c].to_numpy() for c in ("component", "id", "n", *WORDS))
        words = np.stack(words).view(np.uint64)
        shingles = group["s"].combine_chunks()
        values, offsets = shingles.values.to_numpy(), shingles.offsets.to_numpy()
        order = np.argsort(comp, kind="stable")
        cuts = np.flatnonzero(np.diff(comp[order])) + 1
        a, b = [], []
        for rows in np.split(order, cuts):
            if len(rows) < 2:
                continue
            i, j, bits = _near(n[rows], words[:, rows], n[rows], words[:, rows])
            i, j, bits = i[i < j], j[i < j], bits[i < j]
            part = np.arange(len(rows))
            for x in np.argsort(bits, kind="stable"):
                p, q = i[x], j[x]
                if part[p] == part[q]:
                    continue
                left, right = (values[offsets[r] : offsets[r + 1]] for r in (rows[p], rows[q]))
                common = len(np.intersect1d(left, right, assume_unique=True))
                if common >= SIMILAR * (len(left) + len(right) - common) - 1e-9:
                    a.append(ids[rows[p]]), b.append(ids[rows[q]])
                    part[part == part[q]] = part[p]
        return pa.table({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return placed.groupBy("g", "i", "j").applyInArrow(verify, "a long, b long")


def one_of_each(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``docs`` with one row left of each group of similar texts: the smallest doc_id's.

    All columns are kept. A row is known by 128 bits of hash over its columns,
    so rows equal in all of them count as one and rows that share a doc_id do
    not. A null doc_id stays only where its group has no other. Texts without
    words (null, empty) are one group; a text of fewer than five words has its
    whole word sequence as its one shingle. An empty table stays empty.
    """
    cells = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    marked = docs.withColumns({"__h1": F.xxhash64(*cells), "__h2": F.xxhash64(F.lit(1), *cells)})
    printed = checkpointed(prints(marked, ["doc_id", "__h1", "__h2"], k))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__h1", "__h2")
    sets = checkpointed(
        printed.groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", *WORDS)], F.min(order).alias("r"))
    )
    groups = components(candidate_links(sets))
    source = stored(groups.join(sets, groups["node"] == sets["id"]).select("id", "r.__h1", "r.__h2"), "tried")
    # The same plan at every size: texts meet the list by a sorted exchange.
    texts = marked.select("__h1", "__h2", "text").join(source.hint("merge"), ["__h1", "__h2"])
    texts = texts.dropDuplicates(["__h1", "__h2"])
    same = components(similar_links(texts.select("id", "text"), stored(groups, "groups"), k))
    first = (
        sets.join(same, sets["id"] == same["node"], "left")
        .groupBy(F.coalesce("component", "id").alias("c"))
        .agg(F.min("r").alias("r"))
        .select("r.__h1", "r.__h2")
    )
    kept = marked.join(stored(first, "first-of-group"), ["__h1", "__h2"], "left_semi")
    return kept.dropDuplicates(["__h1", "__h2"]).select(*docs.columns)
