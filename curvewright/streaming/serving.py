"""Serving tables kept up to date by a stream: latest prices, history, provider activity.

Each table is one whose parts merge: the last arrival of (instrument, tenor), the
newest n events of an instrument, sums and maxima per provider. A micro-batch is
reduced by the operator that also makes the table in a batch, so a hot instrument
is combined before it moves, and its small result is appended to a log table.
Bytes written follow the micro-batch; compaction merges and expires. Readers
merge what is there, at most ``compact_after`` segments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curvewright.functions.clock import after, floor_to, seconds_between
from curvewright.operators import serving
from curvewright.sources.log_table import SEGMENT, LogTable

#: How long counts per arrival second are kept, by the feed's own clock.
RETENTION_SECONDS = 120


def _last(rows: DataFrame) -> DataFrame:
    """Latest prices of several segments: the last arrival wins, whichever segment holds it."""
    return rows.groupBy("instrument", "tenor").agg(F.max("last").alias("last"))


def _activity(curves: DataFrame) -> DataFrame:
    """Events per provider and arrival time, and the newest event of each instrument."""
    return curves.groupBy("provider", "ingestion_timestamp").agg(F.count(F.lit(1)).alias("events"))


def _recent_activity(rows: DataFrame, retention: int) -> DataFrame:
    """Summed activity; of what is older than ``retention`` a provider's last time alone."""
    summed = rows.groupBy("provider", "ingestion_timestamp").agg(F.sum("events").alias("events"))
    newest = rows.agg(F.max("ingestion_timestamp")).scalar()
    last = rows.groupBy(F.col("provider").alias("_p")).agg(F.max("ingestion_timestamp").alias("_last"))
    return (
        summed.join(F.broadcast(last), F.col("provider").eqNullSafe(F.col("_p")))
        .where((F.col("ingestion_timestamp") > after(newest, -retention)) | (F.col("ingestion_timestamp") == F.col("_last")))
        .drop("_p", "_last")
    )


@dataclass(frozen=True)
class ServingTables:
    """The served tables under ``root``; every read is of the newest committed state."""

    spark: SparkSession
    root: str
    history_rows: int = serving.HISTORY_ROWS
    retention_seconds: int = RETENTION_SECONDS
    compact_after: int = 8

    def _table(self, name: str, merge) -> LogTable:
        return LogTable(self.spark, f"{self.root}/{name}", merge, compact_after=self.compact_after)

    @property
    def latest_log(self) -> LogTable:
        return self._table("latest", _last)

    @property
    def history_log(self) -> LogTable:
        def newest(rows: DataFrame) -> DataFrame:
            return serving.history(rows.drop(SEGMENT), self.history_rows).drop("rank", "event_timestamp_ms")

        return self._table("history", newest)

    @property
    def activity_log(self) -> LogTable:
        return self._table("activity", lambda rows: _recent_activity(rows, self.retention_seconds))

    @property
    def instruments_log(self) -> LogTable:
        def newest(rows: DataFrame) -> DataFrame:
            return rows.groupBy("instrument").agg(F.max("event_timestamp").alias("event_timestamp"))

        return self._table("instruments", newest)

    def update(self, curves: DataFrame, epoch: int) -> None:
        """Take a micro-batch into every table, each exactly once per epoch."""
        self.latest_log.append(serving.latest_prices(curves).select("instrument", "tenor", "last"), epoch)
        newest = serving.history(curves, self.history_rows).drop("rank", "event_timestamp_ms")
        self.history_log.append(newest, epoch)
        self.activity_log.append(_activity(curves), epoch)
        stamps = curves.groupBy("instrument").agg(F.max("event_timestamp").alias("event_timestamp"))
        self.instruments_log.append(stamps, epoch)

    # -- what is served ------------------------------------------------------

    def latest(self) -> DataFrame:
        """As :func:`serving.latest_prices`."""
        return self.latest_log.read().select(
            "instrument", "tenor", "last.price", "last.quality_score",
            F.col("last.event_timestamp").alias("last_updated"), "last",
        )

    def history(self) -> DataFrame:
        """As :func:`serving.history`: the newest events of each instrument, with their rank."""
        return serving.history(self.history_log.read(), self.history_rows)

    def snapshots(self, threshold: float = serving.SNAPSHOT_COMPLETENESS) -> DataFrame:
        """As :func:`serving.snapshots`."""
        return serving.assembled(self.latest(), threshold)

    def health(self, as_of: Column) -> DataFrame:
        """As :func:`serving.provider_health`, for ``as_of`` not behind the feed by more than the retention."""
        recent = F.when(F.col("ingestion_timestamp") > after(as_of, -60), F.col("events")).otherwise(0)
        seen = self.activity_log.read().groupBy("provider").agg(
            F.max("ingestion_timestamp").alias("last_event_at"), F.sum(recent).alias("events_last_60s")
        )
        age = seconds_between(as_of, F.col("last_event_at"))
        return seen.withColumn("status", serving.provider_status(age))

    def minute_counts(self, as_of: Column) -> DataFrame:
        """As :func:`serving.minute_counts` over the retention."""
        return (
            self.activity_log.read()
            .where(F.col("ingestion_timestamp") > after(as_of, -self.retention_seconds))
            .groupBy("provider", floor_to(F.col("ingestion_timestamp"), 60).alias("minute"))
            .agg(F.sum("events").alias("events"))
        )

    def stale_instruments(self, as_of: Column, threshold_seconds: int = serving.STALE_SECONDS) -> DataFrame:
        """As :func:`serving.stale_instruments`."""
        return serving.stale_instruments(self.instruments_log.read(), as_of, threshold_seconds)


def serving_job(curves: DataFrame, tables: ServingTables, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Curve events -> the serving tables; ``every=None`` drains what is available and stops."""
    writer = curves.writeStream.foreachBatch(tables.update).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
