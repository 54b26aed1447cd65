"""Replay: history back into the raw feed under new, reproducible ids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvewright.operators.ordering import first_n, running_position
from curvewright.operators.validate import RAW_FIELDS
from curvewright.sources import vendor
from curvewright.sources.bronze import arrival_range, in_hours, reinflate

def check_request(start: datetime, end: datetime, source: str, provider: str | None) -> None:
    """Reject a job whose window is empty or whose provider is missing."""
    if end <= start:
        raise ValueError("end_time must be after start_time")
    if source in ("bronze_s3", "databento_historical") and not provider:
        raise ValueError(f"provider is required for source {source}")


def request_errors(requests: DataFrame) -> DataFrame:
    """The same checks over a table of requests."""
    return requests.withColumn(
        "error",
        F.when(F.col("end_time") <= F.col("start_time"), "end_time must be after start_time").when(
            F.col("source").isin("bronze_s3", "databento_historical")
            & (F.coalesce("provider", F.lit("")) == ""),
            "provider is required",
        ),
    )


def _replayed(rows: DataFrame, job_id: str, source: str, received_at: Column) -> DataFrame:
    """New ids from the job and the row, so that a retried task repeats them."""
    identity = F.concat_ws("|", F.lit(job_id), "event_id", F.col("arrival_seq").cast("string"))
    return rows.select(
        F.md5(identity).alias("event_id"),
        "provider",
        "instrument",
        received_at.alias("received_at"),
        "event_timestamp",
        "payload",
        "injected_faults",
        F.lit(True).alias("is_replay"),
        F.lit(source).alias("replay_source"),
        F.md5(F.concat(F.lit("trace|"), identity)).alias("trace_id"),
        "arrival_seq",
    )


def replay_bronze(
    bronze: DataFrame,
    job_id: str,
    provider: str,
    start: datetime,
    end: datetime,
    received_at: Column,
    instrument: str | None = None,
    max_age: timedelta = timedelta(hours=24),
    max_future: timedelta = timedelta(minutes=5),
) -> DataFrame:
    """Bronze rows of a provider with event times in [start, end].

    Folders are pruned on the arrival hours that can hold such rows. Rows
    without an event time pass when their folder does.
    """
    check_request(start, end, "bronze_s3", provider)
    low, high = arrival_range(start, end, max_age, max_future)
    rows = in_hours(bronze.where(F.col("provider") == provider), low, high)
    if instrument:
        rows = rows.where(F.col("instrument") == instrument)
    wanted = F.col("event_timestamp").isNull() | F.col("event_timestamp").between(
        F.lit(start), F.lit(end)
    )
    return _replayed(reinflate(rows.where(wanted)), job_id, "bronze_s3", received_at)


_RAW_DOCUMENT = (
    "event_id STRING, provider STRING, instrument STRING, received_at STRING, "
    "event_timestamp STRING, payload STRING, injected_faults ARRAY<STRING>, "
    "is_replay BOOLEAN, replay_source STRING, trace_id STRING"
)


def _replayable(
    letters: DataFrame, start: Column, end: Column, provider: str | None, instrument: str | None
) -> DataFrame:
    chosen = letters.where(F.col("dlq_timestamp").between(start, end))
    if provider:
        chosen = chosen.where(F.col("provider") == provider)
    if instrument:
        chosen = chosen.where(F.col("instrument") == instrument)
    return (
        chosen.withColumn("_raw", F.from_json("raw_payload", _RAW_DOCUMENT))
        .withColumn("_at", F.col("_raw.event_timestamp").try_cast("timestamp"))
        .where("_at IS NOT NULL AND _raw.payload IS NOT NULL")
    )


def left_out(
    letters: DataFrame,
    start: Column,
    end: Column,
    limit: int,
    provider: str | None = None,
    instrument: str | None = None,
) -> DataFrame:
    """One row: how many letters of the window a replay of ``limit`` leaves."""
    return _replayable(letters, start, end, provider, instrument).agg(
        F.greatest(F.count(F.lit(1)) - limit, F.lit(0)).alias("left_out")
    )


def replay_dlq(
    letters: DataFrame,
    job_id: str,
    start: Column,
    end: Column,
    received_at: Column,
    provider: str | None = None,
    instrument: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Dead letters of a window as raw events again: all, or the oldest ``limit``.

    ``left_out`` counts what a limit leaves. Blank providers and instruments come from the letter itself. Letters whose
    document is no raw event are skipped.
    """
    rebuilt = _replayable(letters, start, end, provider, instrument)
    kept = rebuilt if limit is None else first_n(rebuilt, ["dlq_timestamp", "arrival_seq"], limit)
    events = kept.select(
        F.col("original_event_id").alias("event_id"),
        F.coalesce(F.nullif(F.col("_raw.provider"), F.lit("")), "provider").alias("provider"),
        F.coalesce(
            F.nullif(F.col("_raw.instrument"), F.lit("")), "instrument", F.lit("unknown")
        ).alias("instrument"),
        F.col("_at").alias("event_timestamp"),
        F.col("_raw.payload").alias("payload"),
        F.coalesce("_raw.injected_faults", F.array().cast("array<string>")).alias(
            "injected_faults"
        ),
        "arrival_seq",
    )
    return _replayed(events, job_id, "dlq", received_at)


def replay_vendor(
    trades: DataFrame,
    job_id: str,
    start: datetime,
    end: datetime,
    received_at: Column,
    provider: str,
    symbol: str | None = None,
) -> DataFrame:
    """Vendor history of [start, end], optionally of one symbol."""
    check_request(start, end, "databento_historical", provider)
    nanos = F.col("ts_event")
    rows = trades.where(nanos.between(_nanos(start), _nanos(end)))
    if symbol:
        rows = rows.where(F.col("symbol") == symbol)
    return vendor.trade_events(rows, job_id, received_at, provider, symbol)


def _nanos(at: datetime) -> Column:
    return F.unix_micros(F.lit(at)) * 1000


def merge_replay(live: DataFrame, replayed: DataFrame) -> DataFrame:
    """Replayed rows re-enter validation next to live ones."""
    columns = [*RAW_FIELDS, "arrival_seq"]
    return live.select(*columns).unionByName(replayed.select(*columns))


def paced(events: DataFrame, start: Column, per_second: int = 1000) -> DataFrame:
    """When each replayed event may be released, at most ``per_second`` a second.

    A stream limits admission at its source instead (``per_trigger`` of the
    topic reader); a batch hands this schedule on with its rows.
    """
    if per_second < 1:
        raise ValueError("per_second must be positive")
    placed = running_position(events.withColumn("_all", F.lit(1)), ["_all"], "_position")
    wait = F.floor((F.col("_position") - 1) / F.lit(per_second))
    return placed.withColumn(
        "release_at", F.timestamp_micros(F.unix_micros(start) + wait * 1_000_000)
    ).drop("_all", "_position")


def list_jobs(pending: DataFrame, recent: DataFrame, limit: int = 50) -> DataFrame:
    """Known jobs once each, newest first."""
    return (
        pending.unionByName(recent)
        .dropDuplicates(["job_id"])
        .orderBy(F.col("requested_at").desc(), "job_id")
        .limit(limit)
    )


def get_job(jobs: DataFrame, job_id: str) -> DataFrame:
    return jobs.where(F.col("job_id") == job_id)


def audit(jobs: DataFrame, emitted: DataFrame) -> DataFrame:
    """Reported and actually emitted events of each job."""
    counted = emitted.groupBy("job_id").agg(F.count(F.lit(1)).alias("emitted"))
    return jobs.join(counted, "job_id", "left").select(
        "job_id",
        "events_to_replay",
        "events_replayed",
        F.coalesce("emitted", F.lit(0)).alias("emitted"),
        (F.col("events_replayed") == F.col("events_to_replay")).alias("complete"),
    )


def bronze_gaps(
    bronze_hours: DataFrame, providers: DataFrame, first_hour: Column, last_hour: Column
) -> DataFrame:
    """Provider-hours in the range without any Bronze partition.

    ``bronze_hours``: provider and hour of every partition that holds data.
    """
    expected = providers.select("provider").distinct().withColumn(
        "hour", F.explode(F.sequence(first_hour, last_hour, F.expr("INTERVAL 1 HOUR")))
    )
    return expected.join(bronze_hours.select("provider", "hour").distinct(), ["provider", "hour"], "left_anti")


def partition_hours(manifest: DataFrame, keys: Sequence[str] = ("provider", "dt", "hh")) -> DataFrame:
    """Provider and hour of every Bronze partition; given a manifest, no data file is opened."""
    return manifest.select(*keys).distinct().select(
        "provider",
        F.to_timestamp(F.concat_ws(" ", "dt", "hh"), "yyyy-MM-dd HH").alias("hour"),
    )
