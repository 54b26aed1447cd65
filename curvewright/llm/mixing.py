"""Operator 8: mix sources to target weights, cut at exact word budgets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvewright.llm.common import WORD, few_at_once, query, stored, table

#: Weights of the sources in code-point order, null last, repeating.
WEIGHTS = (3, 1, 2)
#: The mix holds SHARE_NUM / SHARE_DEN of all words; no source more than EPOCHS times.
SHARE_NUM, SHARE_DEN, EPOCHS = 3, 2, 2
#: Leading hexadecimal digits of the random key: 4096 ranges of each source.
DIGITS = 3
#: Copies of a row are told apart in blocks of so many, so no array grows with their number.
BLOCK = 4096
#: The bytes between the words of WORD.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def size_of(text: Column) -> Column:
    """The number of words: one letter for each, the spaces between them removed.

    ``regexp_count`` would hold an array of all words of a text.
    """
    letters = F.translate(F.regexp_replace(text, F.lit(WORD), F.lit("w")), SPACES, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column) -> Column:
    """A random key that depends on the row alone, so reruns agree."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size) with the ``target`` of each source, in words.

    Targets are the weights' shares, capped at EPOCHS times a source's size;
    what a cap leaves is shared again by weight until no source is above its
    cap. That fixed point is one level L with target = min(cap, L * weight), and
    the level follows from a running sum in order of cap / weight. One row per
    source: the windows without a partition run over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (n % len(WEIGHTS) + 1).cast("int"))
    caps = sources.select(
        "source",
        "source_size",
        weight.cast("long").alias("w"),
        (F.col("source_size") * EPOCHS).alias("cap"),
    )
    # cap / weight in whole numbers: the least common multiple is divisible by every weight.
    by_ratio = Window.orderBy(
        F.expr(f"cap * {math.lcm(*WEIGHTS)} div w"), F.col("source").asc_nulls_last()
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    room = F.sum("source_size").over(whole) * SHARE_NUM - F.coalesce(F.sum("cap").over(before), F.lit(0)) * SHARE_DEN
    weight_left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))
    ordered = caps.withColumns({"room": room, "w_left": weight_left})
    # The first source whose share fits under its cap sets the level of all later ones.
    fits = F.col("room") * F.col("w") <= F.col("cap") * SHARE_DEN * F.col("w_left")
    level = F.first(F.when(fits, F.struct("room", "w_left")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    share = (F.col("level.room") * F.col("w")).cast("double") / (
        F.col("level.w_left") * SHARE_DEN
    ).cast("double")
    return ordered.withColumn("level", level).select(
        "source",
        "source_size",
        F.coalesce(share, F.col("cap").cast("double")).alias("target"),
    )


def taken(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, __source, __key.

    Within each source the rows stand in order of a random key; the mix takes
    every document ``floor(target / source_size)`` times and, of one more
    epoch, the words up to the exact budget, so the last document is cut.
    Identical rows are combined first (a table may repeat one row without
    bound) and told apart again at the end. Prefix sums are distributed: sums
    of each of the 4096 key ranges of a source, a running sum over those, and a
    window inside each range. Sums and windows read the same shuffle of the
    combined rows, so texts are read once and no table is written in between.
    A null source is a source of its own; a null text has size 0; an empty
    table gives an empty result.
    """
    rows = few_at_once(docs).select(
        F.col("doc_id"),
        F.col("source").alias("__source"),
        size_of(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), F.col("text")).alias("__key"),
    )
    rows = rows.groupBy("__source", "doc_id", "size", "__key").agg(F.count(F.lit(1)).alias("__n"))
    rows = rows.withColumn("__range", F.substring("__key", 1, DIGITS))
    ranges = rows.groupBy("__source", "__range").agg(F.sum(F.col("size") * F.col("__n")).alias("s"))
    earlier = Window.partitionBy("__source").orderBy("__range")
    starts = ranges.withColumn(
        "__start", F.coalesce(F.sum("s").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    goals = targets(
        ranges.groupBy(F.col("__source").alias("source")).agg(F.sum("s").alias("source_size"))
    )
    inside = Window.partitionBy("__source", "__range").orderBy("__key", "doc_id")
    words = F.col("size") * F.col("__n")
    placed = rows.withColumn("__inside", F.sum(words).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - words)
    plan = starts.join(goals, F.col("__source").eqNullSafe(F.col("source"))).select(
        F.col("__source").alias("s"), F.col("__range").alias("r"), "__start", "source_size", "target"
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(0)
    joined = placed.join(plan, F.col("__source").eqNullSafe(F.col("s")) & (F.col("__range") == F.col("r")))
    blocks = joined.withColumn(
        "__first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(BLOCK).cast("long")))
    )
    last = F.least(F.col("__n"), F.col("__first") + BLOCK) - 1
    copies = blocks.withColumn("__copy", F.explode(F.sequence("__first", last)))
    rest = budget - epochs * F.col("source_size") - F.col("__start") - F.col("__inside") - F.col("__copy") * F.col("size")
    return copies.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))).cast("long").alias("taken"),
        "__source",
        "__key",
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself in whole documents: each row of ``docs`` as often as it is taken.

    The document at a source's cut is taken if at least half of it fits. Every
    row compares its own key with its source's cut, one row per source, so
    texts do not move, but for rows equal to the one at the cut: these are
    numbered, by partition and place, and as many are taken as the cut says.
    """
    rows = taken(docs)
    whole = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(0)
    fits = (F.col("size") > 0) & (2 * (F.col("taken") - whole * F.col("size")) >= F.col("size"))
    cuts = rows.groupBy("__source", "__key").agg(F.max(whole).alias("epochs"), F.count_if(fits).alias("n"))
    cuts = cuts.groupBy("__source").agg(
        F.max("epochs").alias("__epochs"), F.max(F.when(F.col("n") > 0, F.struct("__key", "n"))).alias("__cut")
    )
    cuts = stored(cuts, "cuts")
    own = docs.withColumn("__key", random_key(F.col("doc_id"), F.col("text")))
    own = own.join(cuts, docs["source"].eqNullSafe(cuts["__source"]))
    at_cut = F.coalesce(F.col("__key") == F.col("__cut.__key"), F.lit(False))
    more = F.coalesce((F.col("__key") < F.col("__cut.__key")).cast("long"), F.lit(0))
    plain = own.where(~at_cut).select(*docs.columns, (F.col("__epochs") + more).alias("__copies"))
    counted = _numbered(own.where(at_cut), "__key").withColumn(
        "__copies", F.col("__epochs") + (F.col("__number") < F.col("__cut.n")).cast("long")
    )
    return (
        plain.unionByName(counted.select(*docs.columns, "__copies"))
        .where("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
        .select(*docs.columns)
    )


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    """``__number`` from 0 within ``key``: rank in a partition plus the counts of those before."""
    placed = stored(
        rows.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}), "equal-rows"
    )
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__n")).select(
        F.col(key).alias("__k"), F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    rank = F.row_number().over(Window.partitionBy(key, "__part").orderBy("__place")) - 1
    joined = placed.withColumn("__rank", rank).join(starts, (F.col(key) == F.col("__k")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn("__number", F.col("__rank") + F.col("__start"))


ORACLE = f"""
WITH r AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
              WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS w
  FROM r GROUP BY source),
o AS (
  SELECT *, 2 * source_size AS cap,
         3 * sum(source_size) OVER () - 2 * coalesce(sum(2 * source_size) OVER b, 0) AS room,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS w_left,
         row_number() OVER (ORDER BY 2 * source_size * 6 // w, encode(source) NULLS LAST) AS place
  FROM s
  WINDOW b AS (ORDER BY 2 * source_size * 6 // w, encode(source) NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(room, place) AS room, arg_min(w_left, place) AS w_left, min(place) AS place
      FROM o WHERE room * w <= cap * 2 * w_left),
t AS (
  SELECT o.source, o.source_size,
         CASE WHEN f.place IS NOT NULL AND o.place >= f.place
              THEN (f.room * o.w)::DOUBLE / (f.w_left * 2)::DOUBLE ELSE o.cap::DOUBLE END AS target
  FROM o, f),
p AS (
  SELECT r.doc_id, r.size, t.source_size, t.target,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.k, r.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, floor(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM p)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(budget - epochs * source_size - before, size)))::BIGINT AS taken
FROM e
"""


@query("op8_mix", ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed to the sources' targets."""
    return taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
