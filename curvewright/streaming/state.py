"""State that the streams carry from one micro-batch to the next."""

from __future__ import annotations

import pickle
import tempfile
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from curvewright.sources.upserts import existing_table

#: Rows that take no part in repeat detection are dealt over so many keys without state.
BYSTANDER_KEYS = 4096
#: Bytes of one key's rows that a task holds in memory; more are spilled to its own disk.
HELD_BYTES = 32 << 20

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A commit then uploads what a micro-batch changed, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_keyed_state(spark: SparkSession) -> None:
    """Keep keyed state in RocksDB, committed as change logs."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)


@contextmanager
def data_driven(spark: SparkSession) -> Iterator[None]:
    """Queries started inside run a micro-batch only when there is data.

    State that expires by processing time else asks for one micro-batch after the
    other, and a query that drains what is available would never end. Expired
    state goes with the next data.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def decide(
    places: list[tuple[int, int, int]], anchor_ms: int | None, ttl_ms: int
) -> tuple[list[bool], int | None]:
    """Which arrivals of one id repeat, and its anchor after them.

    ``places`` are (microseconds, arrival number, tie break). The first arrival a
    full time to live after the anchor is accepted and anchors anew; all others,
    those before the anchor included, repeat. Work follows the accepted arrivals:
    each is found by bisection.
    """
    order = sorted(range(len(places)), key=places.__getitem__)
    at_ms = [places[i][0] // 1000 for i in order]
    repeated = [True] * len(places)
    k = 0 if anchor_ms is None else bisect_left(at_ms, anchor_ms + ttl_ms)
    while k < len(order):
        repeated[order[k]] = False
        anchor_ms = at_ms[k]
        k = bisect_left(at_ms, anchor_ms + ttl_ms, k)
    return repeated, anchor_ms


class _Held:
    """Rows to be read twice, in memory up to HELD_BYTES and on the task's disk beyond."""

    def __init__(self):
        self._file = tempfile.SpooledTemporaryFile(max_size=HELD_BYTES)
        self._rows = 0

    def add(self, row: tuple) -> None:
        pickle.dump(row, self._file, pickle.HIGHEST_PROTOCOL)
        self._rows += 1

    def __iter__(self) -> Iterator[tuple]:
        self._file.seek(0)
        return (pickle.load(self._file) for _ in range(self._rows))

    def close(self) -> None:
        self._file.close()


class _Repeats(StatefulProcessor):
    """One anchor per event id; the state expires by processing time after its last change."""

    def __init__(self, ttl_ms: int, kept_ms: int, names: list[str]):
        self._ttl, self._kept, self._names = ttl_ms, kept_ms, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._anchor = handle.getValueState("anchor", "at_ms long", self._kept)

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        make, width = Row(*self._names), len(self._names) - 1
        if key[0][0] == "-":
            for row in rows:
                yield make(*tuple(row)[:width], row["_settled"])
            return
        known = self._anchor.get() if self._anchor.exists() else None
        anchor = before = None if known is None else known[0]
        rows = iter(rows)
        first, second = next(rows), next(rows, None)
        if second is None:  # nearly every id comes once
            (repeat,), anchor = decide([_place(first)], anchor, self._ttl)
            yield make(*tuple(first)[:width], repeat)
        else:
            held, places = _Held(), []
            for row in (first, second):
                held.add(tuple(row)[:width])
                places.append(_place(row))
            for row in rows:
                held.add(tuple(row)[:width])
                places.append(_place(row))
            repeated, anchor = decide(places, anchor, self._ttl)
            for row, repeat in zip(held, repeated, strict=True):
                yield make(*row, repeat)
            held.close()
        if anchor != before:
            self._anchor.update((anchor,))

    def close(self) -> None:
        pass


def _place(row: Row) -> tuple[int, int, int]:
    return row["_at"], -1 if row["arrival_seq"] is None else row["arrival_seq"], row["_tie"]


def _settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark rows that repeat another row of their batch: same id, same millisecond, later."""
    for batch in batches:
        keys = batch.column("_key").dictionary_encode().indices.to_numpy()
        ms = batch.column("_at").fill_null(0).to_numpy() // 1000
        seq = batch.column("arrival_seq").fill_null(-1).to_numpy()
        tie = batch.column("_tie").to_numpy()
        order = np.lexsort((tie, seq, batch.column("_at").fill_null(0).to_numpy(), ms, keys))
        again = np.zeros(batch.num_rows, bool)
        again[order[1:]] = (np.diff(keys[order]) == 0) & (np.diff(ms[order]) == 0)
        sound = np.array([k[0] == "+" for k in batch.column("_key").to_pylist()], bool)
        columns = [*batch.columns, pa.array(again & sound)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_settled"])


def flag_repeats_keyed(
    events: DataFrame, eligible: Column, ttl_seconds: int = 3600, forget_seconds: int = 86_400
) -> DataFrame:
    """Streaming form of :func:`curvewright.operators.dedup.flag_repeats`.

    The anchor of each id is keyed state. It needs no watermark: every row, however
    late, comes out with ``is_repeat``. An anchor expires once it has not changed
    for the time to live and ``forget_seconds`` more, by processing time; a copy
    that comes later still is accepted anew. Start the query inside
    :func:`data_driven`. Rows where ``eligible`` is false, or
    without an arrival time, are no repeats and have no state.

    Copies within one millisecond, the usual storm of re-deliveries, are told
    apart before the exchange, so at most one row per id, millisecond and Arrow
    batch meets its anchor. One id's other rows go to one task, which keeps three
    numbers of each and spills the rest.
    """
    spark, schema = events.sparkSession, events.schema
    use_keyed_state(spark)
    tie = F.xxhash64(*[c for c, t in events.dtypes if not t.startswith("map")])
    bystander = F.concat(F.lit("-"), F.pmod(tie, F.lit(BYSTANDER_KEYS)).cast("string"))
    takes_part = eligible & F.col("event_id").isNotNull() & F.col("received_at").isNotNull()
    keyed = events.withColumns({
        "_at": F.unix_micros("received_at"),
        "_tie": tie,
        "_key": F.when(takes_part, F.concat(F.lit("+"), "event_id")).otherwise(bystander),
    })
    settled = keyed.mapInArrow(_settle, T.StructType([*keyed.schema.fields, T.StructField("_settled", T.BooleanType())]))
    settled = settled.withColumn(
        "_key", F.when(F.col("_settled"), F.concat(F.lit("-"), F.pmod("_tie", F.lit(BYSTANDER_KEYS)).cast("string")))
        .otherwise(F.col("_key"))
    )
    flagged = T.StructType([*schema.fields, T.StructField("is_repeat", T.BooleanType())])
    ttl_ms = ttl_seconds * 1000
    steps = _Repeats(ttl_ms, ttl_ms + forget_seconds * 1000, flagged.names)
    return settled.groupBy("_key").transformWithState(steps, flagged, "append", "processingTime")


class CarriedTable:
    """A few values per key carried from one micro-batch to the next.

    For counters and sums of a bounded number of keys (providers, curves), which a
    batch spreads over many tasks. Every micro-batch writes the whole table into
    one of two folders in turn and reads the other: a repeated epoch finds what it
    started from, and the folders do not grow with the number of epochs.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self._spark, self._path, self._key = spark, path, key

    def before(self, epoch: int) -> DataFrame | None:
        rows = existing_table(self._spark, f"{self._path}/slot={(epoch - 1) % 2}") if epoch else None
        return None if rows is None else rows.drop("_epoch")

    def save(self, rows: DataFrame, epoch: int) -> None:
        """The table after ``epoch``: ``rows`` replace their keys."""
        earlier = self.before(epoch)
        if earlier is not None:
            rows = rows.unionByName(earlier.join(rows, self._key, "left_anti"))
        rows.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{self._path}/slot={epoch % 2}")
