"""What the operators of this subpackage share: registry, checkpoints, components."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvewright.session import fresh_path, shared_dir
from curvewright.sources.files import remove

#: Bytes that separate words in the whitespace sense: x20 and x09 to x0D.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of the rows that go to Python at once, and the setting that says so.
BATCH, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

#: Rows of a Parquet table that a task decodes at once where it reads whole texts, and the setting that says so.
READ_ROWS, READ_ROWS_SETTING = 128, "spark.sql.parquet.columnarReaderBatchSize"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``name``; ``sql`` is what DuckDB runs for the same rows."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, its lineage cut.

    The folder is the one ``spark.checkpoint.dir`` names; a session without it
    (a test) gets one. Lost executors cost nothing: the files are shared.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def ascii_lower(column: Column) -> Column:
    """A-Z lowered, everything else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b long): (node, component).

    ``component`` is the smallest node of the component; nodes without an edge
    are not listed. Alternating large-star and small-star steps: every step is
    a grouped minimum and a join on the node, so a hub is a skewed join key
    (split by the engine) and never one collected group; the number of steps
    grows with the logarithm of the longest path. Each step is checkpointed.
    """
    links = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = checkpointed(links.distinct())
    if links.isEmpty():
        return links.toDF("node", "component")
    before = None
    while True:
        # Large star: hang every larger neighbour of a node on its smallest one.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: hang a node and its smaller neighbours on the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m")), F.struct(F.col("b").alias("a"), F.col("m")))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .where("a != b")
            .distinct()
        )
        links = checkpointed(small)
        # Stars are reached when neither the links nor their sum change.
        now = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if now == before:
            roots = links.select("b").distinct().select("b", F.col("b").alias("component"))
            return links.union(roots).toDF("node", "component")
        before = now


def bounded(df: DataFrame) -> DataFrame:
    """``df`` for Python: its session sends rows in batches of BATCH bytes, unless it was set otherwise.

    The setting of 10,000 rows alone lets a batch grow with the texts' length, and
    a task holds several copies of one, in the executor's direct memory and in Python.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH))
    return df


def few_at_once(df: DataFrame) -> DataFrame:
    """``df`` of whole texts: its session's reader decodes READ_ROWS rows at once, unless it was set otherwise.

    The default of 4096 rows lets the reader's arrays grow with the texts' length, by
    doubling, anew for every file; each is one large object in the executor's heap.
    """
    conf = df.sparkSession.conf
    if conf.get(READ_ROWS_SETTING, None) is None:
        conf.set(READ_ROWS_SETTING, str(READ_ROWS))
    return df


def text_map(
    df: DataFrame, text: str, keep: list[str], added: str, work: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """Columns ``keep`` of ``df`` plus what ``work`` makes of each Arrow batch of texts.

    ``added`` is the schema of the new columns. Rows stay where they are; the
    memory of a task is that of one batch.
    """
    schema = T.StructType([df.schema[c] for c in keep] + T.StructType.fromDDL(added).fields)
    names = schema.names
    sent = [F.col(f"`{c}`") for c in keep]
    at = keep.index(text) if text in keep else len(keep)
    if text not in keep:
        sent.append(F.col(text).alias("__text"))

    def run(batches):
        for batch in batches:
            made = work(batch.column(at))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + made, names=names)

    return bounded(df.select(*sent)).mapInArrow(run, schema)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    chars = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return chars[ends[0] : ends[-1]], ends - ends[0]


class Rewritten:
    """A table of a loop: every round's rows are written once, and those of the round before go.

    A reliable checkpoint computes its last stage twice, once to count and once to write.
    """

    def __init__(self, name: str):
        self.name, self.path = name, None

    def put(self, df: DataFrame) -> DataFrame:
        spark, before = df.sparkSession, self.path
        self.path = fresh_path(spark, f"llm-{self.name}")
        df.write.parquet(self.path)
        if before is not None:
            remove(spark, before)
        return spark.read.schema(df.schema).parquet(self.path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back.

    Unlike a checkpoint the table has its true size, so the engine broadcasts
    it only if it really is below the session's threshold.
    """
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
