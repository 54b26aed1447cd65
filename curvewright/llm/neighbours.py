"""Operator 4: approximate nearest neighbours by NN-descent and greedy graph search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvewright.llm.common import Rewritten, query, stored, table

#: Neighbours of each node; most members of one comparison in a task.
DEGREE, BLOCK = 30, 256
#: Better neighbours that a member gets from one comparison.
OFFERS = 12
#: Nodes whose surroundings one task of a round compares.
BUCKET = 256
#: Random splits that give the first graph; the share of changed edges at which descent ends.
SPLITS, SETTLED = 3, 0.05
#: Nodes a search keeps, and nodes it expands in a step.
BEAM, STEP = 192, 64
#: Vectors of one code up to which they are scored row by row; more are scored in tiles of BLOCK.
FEW = 8


def _stack(column: pa.ChunkedArray, kind=np.float32) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _units(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of length one from their bytes, one signed byte a component."""
    rows = column.to_pylist()
    x = np.frombuffer(b"".join(rows), np.int8).reshape(len(rows), -1).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, which changes no bit, so that no square overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) if len(x) else x


def prepared(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, own, vec double array): the rows that take part; equal vectors share ``own``.

    Out stay rows without vec_id, and vectors that are null, zero, hold a null or
    a non-finite component, or have another dimension than most.
    """
    v = F.col("vec")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is not None:
        rows = rows.where(F.size("vec") == common["d"])
    # Minus zero and zero are one number.
    rows = rows.withColumn("vec", F.transform("vec", lambda x: x + 0.0))
    return rows.withColumn("own", F.xxhash64("vec"))


def _coded(rows: DataFrame) -> DataFrame:
    """``rows`` with code, the direction in a byte a component, and node: equal codes share one.

    The code serves to find neighbours; scores are of the original vectors.
    """

    def work(batches):
        for batch in batches:
            x = _stack(pa.chunked_array([batch.column(2)]), np.float64)
            coded = np.rint(x / np.abs(x).max(axis=1, keepdims=True) * 127).astype(np.int8)
            codes = pa.array([c.tobytes() for c in coded], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=["vec_id", "own", "vec", "code"])

    sent = rows.select("vec_id", "own", "vec")
    coded = sent.mapInArrow(work, "vec_id long, own long, vec array<double>, code binary")
    return coded.withColumn("node", F.xxhash64("code"))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row of a and of b, in double precision; equal rows give equal bits wherever they stand."""
    a, b = _scaled(a), _scaled(b)
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _edges(u: list, v: list, s: list) -> pa.Table:
    cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
    return pa.table({"u": cat(u, np.int64), "v": cat(v, np.int64), "s": cat(s, np.float32)})


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest finite entries of every row."""
    k = min(k, sims.shape[1])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(sims)), k)
    cols = top.ravel()
    keep = np.isfinite(sims[rows, cols])
    return rows[keep], cols[keep]


def _first_graph(nodes: DataFrame, count: int, degree: int, seed: int) -> DataFrame:
    """Edges (u, v, s) from exact comparison inside random cells of about BLOCK nodes.

    A cell is the sign pattern over random hyperplanes; cells that come out
    larger are cut by a hash, so no task compares more than a few blocks.
    """
    bits = max(0, int(np.ceil(np.log2(max(1, count / (BLOCK / 2))))))
    found = None
    for split in range(SPLITS):

        def cell(batches, split=split):
            for batch in batches:
                x = _units(batch.column(1))
                planes = np.random.default_rng([seed, split]).standard_normal((x.shape[1], bits)).astype(np.float32)
                code = ((x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code)], names=["node", "vec", "cell"])

        def compare(group: pa.Table) -> pa.Table:
            x, ids = _units(group["vec"]), group["node"].to_numpy()
            u, v, s = [], [], []
            for at in range(0, len(x), BLOCK):
                sims = x[at : at + BLOCK] @ x.T
                sims[np.arange(len(sims)), at + np.arange(len(sims))] = -np.inf
                i, j = _best(sims, degree)
                u.append(ids[at + i]), v.append(ids[j]), s.append(sims[i, j])
            return _edges(u, v, s)

        celled = nodes.mapInArrow(cell, "node long, vec binary, cell long")
        sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK)).alias("parts"))
        cut = celled.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("node", F.lit(split)), F.col("parts")))
        edges = cut.groupBy("cell", "part").applyInArrow(compare, "u long, v long, s float")
        found = edges if found is None else found.unionByName(edges)
    return found


def _top(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` best distinct edges of each u; an edge known before stays old."""
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), F.xxhash64("u", "v"), "v"))
    return (
        edges.repartition("u")
        .groupBy("u", "v")
        .agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
        .withColumn("r", rank)
        .where(F.col("r") <= degree)
        .drop("r")
    )


def graph(nodes: DataFrame, degree: int = DEGREE, seed: int = 7) -> DataFrame:
    """(u, v, s): for each node about its ``degree`` most similar nodes, by NN-descent.

    A round joins, around every node, its neighbours and those it is a neighbour
    of: neighbours of neighbours are likely neighbours. Only pairs with an edge
    that is new are compared and only pairs better than the worse end's list are
    emitted, so rounds get cheaper; they end when few edges change. The members
    around a node that many point to are cut into parts, so a hub is many small
    groups. Each round is written once.
    """
    count = nodes.count()
    edges = _first_graph(nodes, count, degree, seed).withColumn("fresh", F.lit(True))
    rounds, joined = Rewritten("edges"), Rewritten("ties")
    edges = rounds.put(_top(edges, degree))

    def join_around(ties: pa.Table, members: pa.Table) -> pa.Table:
        ids, inverse = np.unique(members["member"].to_numpy(), return_index=True)
        x, worst = _units(members["vec"])[inverse], members["worst"].to_numpy()[inverse]
        center, part = ties["center"].to_numpy(), ties["part"].to_numpy()
        order = np.lexsort((part, center))
        center, part, fresh = center[order], part[order], ties["fresh"].to_numpy(zero_copy_only=False)[order]
        at = np.searchsorted(ids, ties["member"].to_numpy()[order])
        bounds = np.flatnonzero((np.diff(center) != 0) | (np.diff(part) != 0)) + 1
        u, v, s = [], [], []
        for a, b in zip(np.append(0, bounds), np.append(bounds, len(at)), strict=True):
            m = at[a:b]
            sims = x[m] @ x[m].T
            sims[~(fresh[a:b, None] | fresh[None, a:b]) | (sims <= worst[m, None])] = -np.inf
            np.fill_diagonal(sims, -np.inf)
            i, j = _best(sims, OFFERS)
            u.append(ids[m[i]]), v.append(ids[m[j]]), s.append(sims[i, j])
        return _edges(u, v, s)

    buckets = max(1, -(-count // BUCKET))
    while True:
        around = (
            edges.select(F.col("u").alias("center"), F.col("v").alias("member"), "fresh")
            .unionByName(edges.select(F.col("v").alias("center"), F.col("u").alias("member"), "fresh"))
            .groupBy("center", "member")
            .agg(F.max("fresh").alias("fresh"))
        )
        parts = around.groupBy("center").agg(
            F.ceil(F.count(F.lit(1)) / (5 * degree)).alias("parts"), F.max("fresh").alias("any")
        )
        worst = edges.groupBy("u").agg(
            F.when(F.count(F.lit(1)) >= degree, F.min("s")).otherwise(F.lit(-2.0)).cast("float").alias("worst")
        )
        members = nodes.join(worst, nodes["node"] == worst["u"], "left").select(
            F.col("node").alias("member"), "vec", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst")
        )
        ties = (
            around.join(parts.where("any"), "center")
            .withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")))
            .select("center", "part", "member", "fresh")
            .withColumn("bucket", F.pmod(F.xxhash64("center", "part"), F.lit(buckets)))
        )
        ties = joined.put(ties)
        # A vector goes to a bucket once, however many of its surroundings it is in.
        needed = ties.select(F.col("bucket").alias("place"), F.col("member").alias("which")).distinct()
        needed = needed.join(members, F.col("which") == F.col("member")).select("place", "member", "vec", "worst")
        better = (
            ties.groupBy("bucket")
            .cogroup(needed.groupBy("place"))
            .applyInArrow(join_around, "u long, v long, s float")
        )
        edges = rounds.put(
            _top(
                edges.withColumn("fresh", F.lit(False)).unionByName(better.withColumn("fresh", F.lit(True))), degree
            )
        )
        # Lists only improve, so this comes to pass.
        if edges.where("fresh").count() <= SETTLED * count * degree:
            return edges.select("u", "v", "s")


def search(queries: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(q, v): for each query node the BEAM most similar nodes a greedy search meets.

    The search starts at the query's own node. Each step expands the best nodes
    not yet expanded, over edges in both directions (of those that lead to a
    node, its 2 * DEGREE best), and keeps the best BEAM; it ends when no query
    has an unexpanded node left.
    """
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), F.xxhash64("u", "v"), "v"))
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "s").withColumn("r", rank)
    ways = edges.select("u", "v").unionByName(back.where(F.col("r") <= 2 * DEGREE).select("u", "v")).distinct()
    ways, beams = stored(ways, "ways"), Rewritten("beam")
    asked = queries.select(F.col("node").alias("q")).distinct()
    # Written, so that the engine broadcasts it if it really is small.
    asked = stored(asked.join(nodes, asked["q"] == nodes["node"]).select("q", F.col("vec").alias("qvec")), "asked")
    best = Window.partitionBy("q").orderBy(F.desc("s"), "v")
    todo = Window.partitionBy("q").orderBy("done", F.desc("s"), "v")

    def score(batches):
        for batch in batches:
            s = np.einsum("ij,ij->i", *(_units(batch.column(i)) for i in (2, 3))) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float32())], names=["q", "v", "s"])

    beam = beams.put(
        asked.select("q", F.col("q").alias("v"), F.lit(2.0).cast("float").alias("s"), F.lit(False).alias("done"))
    )
    while True:  # a beam only improves, so no node that left it returns and this ends
        turn = beam.withColumn("r", F.row_number().over(todo)).select(
            "q", "v", "s", "done", (~F.col("done") & (F.col("r") <= STEP)).alias("now")
        )
        reached = turn.where("now").select("q", F.col("v").alias("u")).join(ways, "u").select("q", "v").distinct()
        measured = (
            reached.join(nodes, reached["v"] == nodes["node"])
            .join(asked, "q")
            .select("q", "v", "vec", "qvec")
            .mapInArrow(score, "q long, v long, s float")
            .withColumn("done", F.lit(False))
        )
        # A node met again is measured again, and is one row with what the beam knew of it.
        beam = beams.put(
            turn.select("q", "v", "s", (F.col("done") | F.col("now")).alias("done"))
            .unionByName(measured)
            .repartition("q")
            .groupBy("q", "v")
            .agg(F.max("s").alias("s"), F.max("done").alias("done"))
            .withColumn("r", F.row_number().over(best))
            .where(F.col("r") <= BEAM)
            .drop("r")
        )
        if beam.where("not done").isEmpty():
            return beam.select("q", "v")


def _scored(asked: DataFrame, rows: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(q, own, least, score): cosines of query vectors q and the vectors of the nodes found for them.

    Vectors of nodes with few are all listed. Where many vectors share a code the
    k + 1 best of every tile are: each query meets each tile of them.
    """
    held = rows.groupBy("node", "own").agg(F.first("vec").alias("vec"), F.min("vec_id").alias("least"))
    size = F.count(F.lit(1))
    full = stored(
        held.groupBy("node").agg(size.alias("n")).where(F.col("n") > FEW)
        .select("node", F.ceil(F.col("n") / BLOCK).alias("tiles")),
        "full",
    )
    asks = asked.groupBy(F.col("node").alias("at"), F.col("own").alias("q")).agg(F.first("vec").alias("qvec"))
    asks = asks.join(found.select(F.col("q").alias("at"), F.col("v").alias("node")), "at").drop("at")
    schema = "q long, own long, least long, score double"

    def by_row(batches):
        for batch in batches:
            a, b = (_stack(pa.chunked_array([batch.column(i)]), np.float64) for i in (3, 4))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(_cosines(a, b))], names=["q", "own", "least", "score"])

    def by_tile(some: pa.Table, tile: pa.Table) -> pa.Table:
        out = [np.zeros((2, 0), np.int64)]
        scores = [np.zeros(0)]
        if len(some) and len(tile):
            a, b = _stack(some["qvec"], np.float64), _stack(tile["vec"], np.float64)
            least = tile["least"].to_numpy()
            for i in range(len(a)):
                s = _cosines(np.ascontiguousarray(np.broadcast_to(a[i], b.shape)), b)
                top = np.lexsort((least, -s))[: k + 1]
                out.append(np.stack((np.full(len(top), i), top))), scores.append(s[top])
        i, j = np.concatenate(out, axis=1)
        pick = lambda t, c, x: t[c].to_numpy()[x] if len(x) else np.zeros(0, np.int64)
        return pa.table(
            {"q": pick(some, "q", i), "own": pick(tile, "own", j), "least": pick(tile, "least", j), "score": np.concatenate(scores)}
        )

    if full.isEmpty():
        pairs = asks.join(held, "node")
        return pairs.select("q", "own", "least", "qvec", "vec").mapInArrow(by_row, schema)
    pairs = asks.join(held.join(full, "node", "left_anti"), "node")
    rowwise = pairs.select("q", "own", "least", "qvec", "vec").mapInArrow(by_row, schema)
    many = asks.join(full, "node")
    parts = many.groupBy("node").agg(F.ceil(size / BLOCK).alias("parts"))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = many.join(parts, "node").withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts"))).withColumn("tile", every("tiles"))
    right = held.join(full, "node").join(parts, "node")
    right = right.withColumn("tile", F.pmod(F.xxhash64("own"), F.col("tiles"))).withColumn("part", every("parts"))
    tiled = (
        left.select("node", "tile", "part", "q", "qvec").groupBy("node", "tile", "part")
        .cogroup(right.select("node", "tile", "part", "own", "least", "vec").groupBy("node", "tile", "part"))
        .applyInArrow(by_tile, schema)
    )
    return rowwise.unionByName(tiled)


def nearest(vectors: DataFrame, chosen, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows found for the rows ``chosen`` picks.

    ``chosen`` is a condition on vec_id. Nearness is the cosine in double
    precision on the original vectors; ties go to the smaller vec_id; a row is
    no neighbour of its own vec_id; repeated rows count once. Fewer candidates
    than ``k`` are all returned; rows that ``prepared`` leaves out take no part;
    an empty table gives an empty result.

    Vectors of equal code are one node, and all of them are scored when it is
    found. Rows of equal vectors are scored once, with the ``k + 1`` smallest
    vec_ids as members: more of them can never be among the ``k`` nearest, as a
    query itself is at most one of them.
    """
    rows = stored(_coded(prepared(vectors).distinct()), "coded")
    nodes = stored(rows.groupBy("node").agg(F.first("code").alias("vec")), "nodes")
    rank = F.row_number().over(Window.partitionBy("own").orderBy("vec_id"))
    members = rows.select("own", "vec_id").withColumn("r", rank).where(F.col("r") <= k + 1).drop("r")
    asked = rows.where(chosen)
    queries = asked.select(F.col("vec_id").alias("query_id"), F.col("own").alias("q"))
    found = search(asked.select("node"), nodes, graph(nodes))
    scored = _scored(asked, rows, found, k)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "least")
    # The k nearest rows are of the k + 1 nearest vectors, as one may hold but the query itself.
    scored = scored.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    candidates = queries.join(scored, "q").join(members, "own").where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


@query("op4_neighbours")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
