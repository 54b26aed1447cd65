"""Serving tables: latest prices, history, snapshots, provider health, staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvewright.functions.clock import after, floor_to, seconds_between
from curvewright.functions.scores import validation_points
from curvewright.schemas import SERVING_EXPECTED_TENORS

HISTORY_ROWS = 1000
#: Parts in which the events of one instrument are ranked before they meet.
HISTORY_PARTS = 64
SNAPSHOT_COMPLETENESS = 0.80
STALE_SECONDS = 600
HEALTHY_SECONDS = 300
DEGRADED_SECONDS = 900

_ARRIVAL = ("ingestion_timestamp", "arrival_seq")


def latest_prices(curves: DataFrame) -> DataFrame:
    """Last arriving price per (instrument, tenor), with the arrival itself."""
    return (
        curves.groupBy("instrument", "tenor")
        .agg(
            F.max(
                F.struct(
                    *_ARRIVAL,
                    "price",
                    "quality_score",
                    "event_timestamp",
                    "curve_name",
                    "version",
                    "provider",
                )
            ).alias("last")
        )
        .select(
            "instrument",
            "tenor",
            "last.price",
            "last.quality_score",
            F.col("last.event_timestamp").alias("last_updated"),
            "last",
        )
    )


def history(curves: DataFrame, rows: int = HISTORY_ROWS) -> DataFrame:
    """Newest ``rows`` events per instrument, whatever the number.

    Counts per instrument and hour, combined before they move, tell the hour in
    which the last wanted event lies; older events go before anything is ranked.
    What is left of a hot instrument is ranked in parts by the task that read it,
    which keeps ``rows`` of its own before they move, and the parts' newest rows
    are ranked once more: the last task gets at most ``rows`` of each part,
    even if all events are of one hour.
    """
    order = F.col("event_timestamp_ms").desc(), F.col("event_id").desc()
    of_part = Window.partitionBy("instrument", "_share").orderBy(*order)
    newest = Window.partitionBy("instrument").orderBy(*order)
    hour = F.expr("unix_seconds(event_timestamp) div 3600")
    later = Window.partitionBy("instrument").orderBy(F.col("_hour").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = curves.groupBy("instrument", hour.alias("_hour")).agg(F.count(F.lit(1)).alias("_events"))
    cut = (
        counts.withColumn("_later", F.coalesce(F.sum("_events").over(later), F.lit(0)))
        .where(F.col("_later") < rows)
        .groupBy(F.col("instrument").alias("_of"))
        .agg(F.min("_hour").alias("_cut"))
    )
    reached = curves.join(cut, F.col("instrument").eqNullSafe(F.col("_of")) & (hour >= F.col("_cut")))
    return (
        reached.drop("_of", "_cut")
        .withColumn("event_timestamp_ms", F.unix_millis("event_timestamp"))
        .withColumn("_share", F.spark_partition_id() % HISTORY_PARTS)
        .withColumn("rank", F.row_number().over(of_part))
        .where(F.col("rank") <= rows)
        .drop("_share")
        .withColumn("rank", F.row_number().over(newest))
        .where(F.col("rank") <= rows)
    )


def expected_tenors(instrument: Column) -> Column:
    entries = ", ".join(f"'{name}', {n}" for name, n in SERVING_EXPECTED_TENORS.items())
    return F.element_at(F.expr(f"map({entries})"), instrument)


def snapshots(curves: DataFrame, threshold: float = SNAPSHOT_COMPLETENESS) -> DataFrame:
    """Per instrument, every tenor seen; described by its last event.

    Tenors are never forgotten, so once complete enough an instrument is
    rewritten by each event: the stored state is that of the last one.
    """
    return assembled(latest_prices(curves), threshold)


def assembled(latest: DataFrame, threshold: float = SNAPSHOT_COMPLETENESS) -> DataFrame:
    """Snapshots of instruments from their latest prices."""
    whole = latest.groupBy("instrument").agg(
        F.array_sort(
            F.collect_list(F.struct("tenor", "price", "quality_score", "last_updated"))
        ).alias("tenors"),
        F.max("last").alias("last"),
    )
    ratio = F.size("tenors") / expected_tenors(F.col("instrument"))
    return (
        whole.where(ratio >= threshold)
        .withColumn("completeness", F.least(F.lit(1.0), ratio))
        .select(
            "instrument",
            "last.curve_name",
            "last.provider",
            F.col("last.event_timestamp").alias("as_of"),
            "last.version",
            "tenors",
            F.size("tenors").alias("tenor_count"),
            "completeness",
            F.lit(True).alias("is_authoritative"),
        )
    )


def provider_status(age_seconds: Column) -> Column:
    return (
        F.when(age_seconds.isNull(), "unknown")
        .when(age_seconds < HEALTHY_SECONDS, "healthy")
        .when(age_seconds < DEGRADED_SECONDS, "degraded")
        .otherwise("outage")
    )


def provider_health(curves: DataFrame, as_of: Column, known: DataFrame | None = None) -> DataFrame:
    """Last event, events of the last minute and status per provider.

    Providers listed in ``known`` without any event are ``unknown``.
    """
    recent = F.col("ingestion_timestamp") > after(as_of, -60)
    seen = curves.groupBy("provider").agg(
        F.max("ingestion_timestamp").alias("last_event_at"),
        F.count_if(recent).alias("events_last_60s"),
    )
    if known is not None:
        seen = known.select("provider").distinct().join(seen, "provider", "left").withColumn(
            "events_last_60s", F.coalesce("events_last_60s", F.lit(0))
        )
    return seen.withColumn("status", provider_status(seconds_between(as_of, F.col("last_event_at"))))


def provider_quality(outcomes: DataFrame, as_of: Column, window_seconds: int = 60) -> DataFrame:
    """Dead-letter rate and median / 95th percentile score of recent events.

    Scores are whole hundredths, so the percentile state holds at most 101 values.
    """
    passed = F.col("outcome") == "passed"
    points = F.when(passed, validation_points(F.col("injected_faults")))
    return (
        outcomes.where(F.col("received_at") > after(as_of, -window_seconds))
        .groupBy("provider")
        .agg(
            F.count(F.lit(1)).alias("events"),
            (F.count_if(F.col("outcome") == "failed") / F.count(F.lit(1))).alias("dlq_rate"),
            (F.percentile(points, 0.5) / 100).alias("quality_p50"),
            (F.percentile(points, 0.95) / 100).alias("quality_p95"),
        )
    )


def minute_counts(curves: DataFrame, as_of: Column, retention_seconds: int = 120) -> DataFrame:
    """Events per provider and minute, for the minutes still retained."""
    return (
        curves.where(F.col("ingestion_timestamp") > after(as_of, -retention_seconds))
        .groupBy("provider", floor_to(F.col("ingestion_timestamp"), 60).alias("minute"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def stale_instruments(
    curves: DataFrame, as_of: Column, threshold_seconds: int = STALE_SECONDS
) -> DataFrame:
    newest = curves.groupBy("instrument").agg(F.max("event_timestamp").alias("newest_event"))
    return newest.where(seconds_between(as_of, F.col("newest_event")) > threshold_seconds)


def stale_report(
    curves: DataFrame,
    as_of: Column,
    threshold_seconds: int = STALE_SECONDS,
    completeness: float = SNAPSHOT_COMPLETENESS,
) -> DataFrame:
    """Stale instruments with the age of their stored snapshot, if there is one."""
    stored = snapshots(curves, completeness).select("instrument", F.col("as_of").alias("last_event_at"))
    return (
        stale_instruments(curves, as_of, threshold_seconds)
        .join(stored, "instrument", "left")
        .withColumn(
            "staleness_seconds", F.round(seconds_between(as_of, F.col("last_event_at")), 1)
        )
    )
