"""How far a stream is behind its topics, read from the offsets its checkpoint holds."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.sources import files
from curvewright.sources.topic_log import Log


def committed_offsets(spark: SparkSession, checkpoint: str) -> list[dict]:
    """Per source the offsets up to which the last finished micro-batch has read; [] before the first.

    A micro-batch counts once it is in the commit log; one that only has planned
    its offsets is still to be read.
    """
    done = [int(n) for n in files.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return []
    lines = files.read_text(spark, f"{checkpoint}/offsets/{max(done)}").splitlines()
    # A version, the batch's metadata, then a line per source; "-" for one without data.
    return [json.loads(line) for line in lines[2:] if line != "-"]


def positions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(topic, partition, position) of a checkpoint; a topic log has partition 0 alone."""
    rows = []
    for source in committed_offsets(spark, checkpoint):
        for topic, at in source.items():
            parts = at.items() if isinstance(at, dict) else [(0, at)]
            rows += [(topic, int(part), int(offset)) for part, offset in parts]
    return spark.createDataFrame(rows, "topic string, partition int, position long")


def lag(ends: DataFrame, at: DataFrame) -> DataFrame:
    """(topic, partition, end, position, lag): messages that the stream has not read.

    ``ends`` has (topic, partition, end); a partition never read is behind by all of it.
    """
    position = F.coalesce("position", F.lit(0).cast("long"))
    return ends.join(at, ["topic", "partition"], "left").select(
        "topic", "partition", "end", position.alias("position"), (F.col("end") - position).alias("lag")
    )


def log_lag(spark: SparkSession, root: str, topics: str, checkpoint: str) -> DataFrame:
    """Lag of a stream over the topic log at ``root``."""
    log = Log(root)
    ends = [(topic, 0, log.end(topic)) for topic in topics.split(",")]
    return lag(spark.createDataFrame(ends, "topic string, partition int, end long"), positions(spark, checkpoint))
