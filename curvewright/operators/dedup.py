"""At-most-once acceptance of an event id inside a fixed time to live.

The first arrival of an id is accepted and anchors its time to live; arrivals
inside it are repeats and do not extend it; the first arrival after it anchors
a new one. Time is measured in whole milliseconds.

Most ids arrive once, so the ids that arrive more often are counted out first
and only their arrivals take part in what follows; the result is the short list
of repeats, which is joined back, not the long one of accepted rows.

An id may be repeated without limit, so ids are never gathered whole:

1. arrivals are combined, before any shuffle, into one row per (id,
   millisecond) and then one summary per (id, cell), a cell being a sixtieth
   of the time to live;
2. a silence of a full time to live always ends the anchor, so summaries split
   into sessions. A session shorter than the time to live has exactly one
   accepted row: its first;
3. only longer sessions need the chain of anchors. Their arrivals, already
   combined per millisecond, are sorted and scanned as a stream that remembers
   one number, whatever the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvewright.session import fresh_path

KEY = ["event_id", "received_at", "arrival_seq"]


def anchor_scan(ttl_ms: int):
    """Stream over rows sorted by (event_id, session, at_ms).

    Yields every anchor after the first of each session.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        anchor = 0
        for batch in batches:
            ids = batch.column("event_id").to_pylist()
            sessions = batch.column("_session").to_numpy(zero_copy_only=False)
            at = batch.column("_at_ms").to_numpy(zero_copy_only=False)
            keep: list[int] = []
            rows = batch.num_rows
            starts = [
                k
                for k in range(rows)
                if k == 0 or ids[k] != ids[k - 1] or sessions[k] != sessions[k - 1]
            ]
            bounds = [*starts, rows]
            for start, end in zip(bounds[:-1], bounds[1:]):
                group = (ids[start], int(sessions[start]))
                i = start
                if group != current:
                    # The opener itself is already known to be accepted.
                    current, anchor = group, int(at[start])
                    i = start + 1
                while i < end:
                    i = start + int(np.searchsorted(at[start:end], anchor + ttl_ms))
                    if i < end:
                        anchor = int(at[i])
                        keep.append(i)
            if keep:
                yield batch.take(pa.array(keep, pa.int64())).select(
                    ["event_id", "received_at", "arrival_seq"]
                )

    return scan


def accepted_arrivals(events: DataFrame, ttl_seconds: int = 3600) -> DataFrame:
    """``(event_id, received_at, arrival_seq)`` of every accepted arrival."""
    if not 60 <= ttl_seconds <= 86_400:
        raise ValueError("ttl_seconds must lie in 60..86400")
    ttl_ms = ttl_seconds * 1000
    cell_ms = ttl_ms // 60

    # One row per id and millisecond.
    at_ms = F.unix_millis("received_at")
    arrivals = (
        events.select(
            "event_id",
            at_ms.alias("_at_ms"),
            (at_ms - F.pmod(at_ms, F.lit(cell_ms))).alias("_cell"),
            F.struct("received_at", "arrival_seq").alias("_arrival"),
        )
        .where("event_id IS NOT NULL AND _cell IS NOT NULL")
        .groupBy("event_id", "_cell", "_at_ms")
        .agg(F.min("_arrival").alias("_first"))
    )

    by_cell = Window.partitionBy("event_id").orderBy("_cell")
    cells = (
        arrivals.groupBy("event_id", "_cell")
        .agg(
            F.min("_first").alias("_first"),
            F.min("_at_ms").alias("_low"),
            F.max("_at_ms").alias("_high"),
        )
        .withColumn("_before", F.lag("_high").over(by_cell))
        .withColumn(
            "_opens",
            F.col("_before").isNull() | (F.col("_low") - F.col("_before") >= ttl_ms),
        )
        .withColumn("_session", F.sum(F.col("_opens").cast("long")).over(by_cell))
    )
    whole = Window.partitionBy("event_id", "_session")
    cells = cells.withColumn("_span", F.max("_high").over(whole) - F.min("_low").over(whole))

    # A session's first arrival is always accepted.
    openers = cells.where("_opens").select(
        "event_id",
        F.col("_first.received_at").alias("received_at"),
        F.col("_first.arrival_seq").alias("arrival_seq"),
    )

    long_cells = cells.where(F.col("_span") >= ttl_ms).select("event_id", "_cell", "_session")
    residue = (
        arrivals.join(long_cells, ["event_id", "_cell"])
        .select(
            "event_id",
            "_session",
            "_at_ms",
            F.col("_first.received_at").alias("received_at"),
            F.col("_first.arrival_seq").alias("arrival_seq"),
        )
        .repartition("event_id", "_session")
        .sortWithinPartitions("event_id", "_session", "_at_ms")
        .mapInArrow(
            anchor_scan(ttl_ms), "event_id string, received_at timestamp, arrival_seq long"
        )
    )
    return openers.unionByName(residue)


def repeats(events: DataFrame, ttl_seconds: int = 3600) -> DataFrame:
    """Positions that hold a repeat: (event_id, received_at, arrival_seq, copies, repeated).

    ``copies`` rows stand at the position, ``repeated`` of them are repeats: all,
    or all but one where the position is an accepted one. Written to the shared
    folder: it is needed more than once, and its true size decides how it is joined.
    """
    narrow = events.select(*KEY)
    several = narrow.groupBy("event_id").count().where("count > 1").select("event_id")
    again = narrow.join(several, "event_id", "left_semi")
    path = fresh_path(events.sparkSession, "arrivals")
    again.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")).write.parquet(path)
    arrivals = events.sparkSession.read.parquet(path)
    accepted = accepted_arrivals(arrivals, ttl_seconds).withColumn("accepted", F.lit(1))
    found = (
        arrivals.join(accepted, KEY, "left")
        .withColumn("repeated", F.col("copies") - F.coalesce("accepted", F.lit(0)))
        .where("repeated > 0")
        .drop("accepted")
    )
    path = fresh_path(events.sparkSession, "repeats")
    found.write.parquet(path)
    return events.sparkSession.read.parquet(path)


def _one_accepted(tied: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that share an accepted position, all but one of each position flagged.

    Equal rows are combined to a count before they move and told apart again
    after, so any number of copies is one row in between.
    """
    first = Window.partitionBy(*KEY).orderBy(*[c for c in columns if c not in KEY])
    counted = tied.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    return (
        counted.withColumn("_rank", F.row_number().over(first))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        .select(*columns, ((F.col("_rank") > 1) | (F.col("_copy") > 1)).alias("is_repeat"))
    )


def flag_repeats(events: DataFrame, eligible: Column, ttl_seconds: int = 3600) -> DataFrame:
    """Add ``is_repeat``; rows where ``eligible`` is false take no part.

    Right also for rows that are equal in everything: one of them is accepted.
    """
    columns = events.columns
    found = repeats(events.where(eligible), ttl_seconds)
    flagged = (
        events.join(found, KEY, "left")
        .withColumn("_hit", eligible & F.col("copies").isNotNull())
        .withColumn("_tied", F.col("_hit") & (F.col("copies") > F.col("repeated")))
    )
    plain = [*columns, F.coalesce("_hit", F.lit(False)).alias("is_repeat")]
    if found.where("copies > repeated").isEmpty():
        return flagged.select(*plain)
    single = flagged.where(~F.coalesce("_tied", F.lit(False))).select(*plain)
    return single.unionByName(_one_accepted(flagged.where("_tied"), columns))
