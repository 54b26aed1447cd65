"""Operator 12: Merkle manifest of a dataset, its proofs, and what tampering changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvewright.llm.common import query, stored, table

#: Children of a node.
ARITY = 3
#: Levels that one exchange computes: a task's window holds ARITY ** LEVELS nodes of one group.
LEVELS = 7
#: The columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(column: Column) -> Column:
    """One value of a leaf: its UTF-8 byte count, a colon, the value; a dash for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The digest of a document whose text is ``text``."""
    return digest(*(field(text if c == "text" else F.col(c)) for c in FIELDS))


def places(rows: DataFrame, group: str, order: list[str], copies: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0) and ``m``, the number of rows, of each group.

    A row that stands for several equal ones (``copies``) becomes as many, with
    consecutive places. Rows are dealt by ranges of (group, order), so a hot
    group is many ranges; places inside a range are a bounded window, and a
    range starts where the prefix sum of the earlier ones ends.
    """
    ranged = stored(
        rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()), "manifest-ranged"
    )
    own = Window.partitionBy(group)
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(group, "part").agg(F.sum(copies).alias("s")).select(
        F.col(group).alias("__g"),
        F.col("part").alias("__p"),
        F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"),
        F.sum("s").over(own).alias("m"),
    )
    inside = Window.partitionBy(group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside", F.coalesce(F.sum(copies).over(inside), F.lit(0)))
    first = F.col("before") + F.col("inside")
    return (
        placed.join(starts, (F.col(group) == F.col("__g")) & (F.col("part") == F.col("__p")))
        .withColumn("pos", F.explode(F.sequence(first, first + F.col(copies) - 1)))
        .drop("__g", "__p", "part", "before", "inside", copies)
    )


def climb(nodes: DataFrame) -> DataFrame:
    """LEVELS levels above ``nodes`` (g, pos, m, node, ...), one exchange for all of them.

    A block of ARITY ** LEVELS consecutive nodes of a group never splits a run, so
    one window per block serves every level: nodes of level l are the rows whose
    place is a multiple of ARITY ** l, and their neighbours lie that far behind
    and ahead. Lag and lead at these fixed offsets, masked by the node's slot in
    its run and by the run's length (nothing lies ahead of the last one), are its
    siblings; the first child of a run hashes its parent. Adds ``block``, ``top``
    (on the block's first row, the node above all of it) and ``path``: per level
    the siblings left and right of the row's ancestor there, no entry where a
    group is down to a single node.
    """
    block = F.floor(F.col("pos") / ARITY**LEVELS).cast("long")
    rows = nodes.withColumn("block", block).repartition("g", "block")
    ahead = Window.partitionBy("g", "block").orderBy("pos")
    node, left_nodes, steps = F.col("node"), F.col("m"), []
    for level in range(LEVELS):
        stride = ARITY**level
        at_node = F.col("pos") % stride == 0
        slot = F.floor(F.col("pos") / stride) % ARITY
        many = left_nodes > 1
        rows = rows.withColumn("__d", F.when(at_node, node))
        near = {k: F.lag("__d", k * stride).over(ahead) for k in range(1, ARITY)}
        near |= {-k: F.lead("__d", k * stride).over(ahead) for k in range(1, ARITY)}
        rows = rows.withColumns({f"__n{k}": v for k, v in near.items()})
        behind = [F.when(slot >= k, F.coalesce(f"__n{k}", F.lit(""))).otherwise("") for k in range(ARITY - 1, 0, -1)]
        beyond = [F.when(slot + k < ARITY, F.coalesce(f"__n{-k}", F.lit(""))).otherwise("") for k in range(1, ARITY)]
        step = F.when(at_node & many, F.struct(F.concat(*behind).alias("left"), F.concat(*beyond).alias("right")))
        parent = F.when(many, digest(F.col("__d"), *beyond)).otherwise(F.col("__d"))
        rows = rows.withColumns(
            {f"__s{level}": step, "__d": F.when(F.col("pos") % (stride * ARITY) == 0, parent)}
        ).drop(*(f"__n{k}" for k in near))
        node, left_nodes = F.col("__d"), F.floor((left_nodes + (ARITY - 1)) / ARITY)
        steps.append(f"__s{level}")
    # The ancestor of a level is the latest row so far that is a node there.
    so_far = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.array_compact(F.array(*(F.last(s, ignorenulls=True).over(so_far) for s in steps)))
    return rows.withColumns({"path": path, "top": F.col("__d"), "left_nodes": left_nodes.cast("long")}).drop("__d", *steps)


def tops(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The climbs that bring every group of ``nodes`` down to one node, and those nodes."""
    climbs = []
    while True:
        climbs.append(climb(nodes))
        above = climbs[-1].where(F.col("pos") % ARITY**LEVELS == 0).select(
            "g", F.col("block").alias("pos"), F.col("left_nodes").alias("m"), F.col("top").alias("node")
        )
        nodes = stored(above, "manifest-nodes")
        if (nodes.agg(F.max("m")).first()[0] or 1) == 1:
            return climbs, nodes


def descend(climbs: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of the rows of the first climb, given (g, pos, path, ...) of the nodes above the last."""
    for climbed in reversed(climbs):
        upper = above.select(
            F.col("g").alias("__g"), F.col("pos").alias("__p"), F.col("path").alias("__up"),
            *[c for c in ("subroot", "root") if c in above.columns],
        )
        above = (
            climbed.join(upper, (F.col("g") == F.col("__g")) & (F.col("block") == F.col("__p")))
            .withColumn("path", F.concat("path", "__up"))
            .drop("__g", "__p", "__up", "top", "left_nodes", "block")
        )
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to with the siblings of ``path``."""
    return F.aggregate(path, start, lambda d, step: digest(step["left"], d, step["right"]))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path, changed_leaf.

    Leaves hash FIELDS; per source they ascend by doc_id (nulls first; rows of
    one doc_id by their digest) and every three consecutive nodes become one
    until a single node, the subroot, is left; subroots, ordered by source (null
    first, bytewise), likewise give the root. ``path`` lists from leaf to root
    the digests left and right of the way, ``proof`` joins them. ``tampered`` is
    the text to hash for ``changed_leaf`` instead. A null source is a source of
    its own, a null or empty text has its own leaf, repeated rows are leaves of
    their own with equal digests and a proof each, a very long text is one hash
    input like any other; an empty table gives an empty result. Texts never
    move; rows that are equal are combined before they are ordered.
    """
    text = F.col("text")
    leaves = (
        docs.select(
            "doc_id",
            # Null sorts first and is no join key's null.
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("g"),
            leaf(text).alias("node"),
            leaf(text if tampered is None else tampered).alias("changed_leaf"),
        )
        .groupBy("g", "doc_id", "node", "changed_leaf")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    climbs, subroots = tops(stored(places(leaves, "g", ["doc_id", "node"], "copies"), "manifest-leaves"))
    sources = subroots.select(
        F.lit("").alias("all"), F.col("g").alias("key"), "node", F.lit(1).cast("long").alias("copies")
    )
    placed = places(sources, "all", ["key"], "copies").withColumnRenamed("all", "g")
    placed = stored(placed.withColumn("subroot", F.col("node")), "manifest-subroots")
    root_climbs, root = tops(placed)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    by_source = descend(root_climbs, root.select("g", "pos", F.col("node").alias("root"), nothing.alias("path")))
    # A source's last climb ends in one block, number 0.
    above = by_source.select(F.col("key").alias("g"), F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
    rows = descend(climbs, stored(above, "manifest-roots"))
    return rows.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", "changed_leaf")


def proof(path: Column) -> Column:
    """The siblings of a path in order, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def without_newlines(text: Column, doc_id: Column) -> Column:
    """The contract's tampering: newlines deleted where 2 divides crc32 of the decimal doc_id."""
    return F.when(F.crc32(doc_id.cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)


ORACLE = """
WITH RECURSIVE
stripped AS (
  SELECT *, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS changed
  FROM (SELECT *, CASE WHEN crc & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS t,
          coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
        FROM stripped)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS m,
         row_number() OVER () AS id FROM leaves),
tree AS (
  SELECT 0 AS lvl, g, pos, m, leaf AS d FROM placed
  UNION ALL
  SELECT lvl + 1, g, pos // 3, any_value((m + 2) // 3), sha256(string_agg(d, '' ORDER BY pos))
  FROM tree WHERE m > 1 GROUP BY lvl, g, pos // 3),
subroots AS (SELECT g, d, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS m FROM tree WHERE m = 1),
upper AS (
  SELECT 0 AS lvl, pos, m, d FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, any_value((m + 2) // 3), sha256(string_agg(d, '' ORDER BY pos))
  FROM upper WHERE m > 1 GROUP BY lvl, pos // 3),
near AS (
  SELECT lvl, g, pos, string_agg(d, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
         string_agg(d, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM tree WHERE m > 1 WINDOW r AS (PARTITION BY lvl, g, pos // 3 ORDER BY pos)),
near_upper AS (
  SELECT lvl, pos, string_agg(d, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
         string_agg(d, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM upper WHERE m > 1 WINDOW r AS (PARTITION BY lvl, pos // 3 ORDER BY pos)),
steps AS (
  SELECT p.id, n.lvl AS k, coalesce(n.l, '') AS l, coalesce(n.r, '') AS r
  FROM placed p JOIN near n ON n.g = p.g AND n.pos = p.pos // (3 ** n.lvl)::BIGINT
  UNION ALL
  SELECT p.id, 1000 + n.lvl, coalesce(n.l, ''), coalesce(n.r, '')
  FROM placed p JOIN subroots s ON s.g = p.g JOIN near_upper n ON n.pos = s.pos // (3 ** n.lvl)::BIGINT),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) AS step FROM steps),
proofs AS (SELECT id, max(step) AS last, string_agg(l || r, '' ORDER BY step) AS proof FROM numbered GROUP BY id),
folded AS (
  SELECT id, 0::BIGINT AS step, changed AS d FROM placed
  UNION ALL
  SELECT f.id, n.step, sha256(n.l || f.d || n.r) FROM folded f JOIN numbered n ON n.id = f.id AND n.step = f.step + 1)
SELECT p.doc_id, p.leaf, s.d AS subroot, u.d AS root, sha256(coalesce(q.proof, '')) AS proof_sha256,
       f.d AS folded_root, f.d = u.d AS verified
FROM placed p JOIN subroots s ON s.g = p.g JOIN (SELECT d FROM upper WHERE m = 1) u ON true
LEFT JOIN proofs q ON q.id = p.id JOIN folded f ON f.id = p.id AND f.step = coalesce(q.last, 0)
"""


@query("op12_manifest", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: their leaves, roots and proofs, and which of them tampering breaks."""
    docs = table(spark, sf_dir, "documents")
    rows = manifest(docs, without_newlines(F.col("text"), F.col("doc_id")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        folded(F.col("changed_leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
