"""Provider quality history at three granularities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvewright.functions.scores import validation_points
from curvewright.operators.quantiles import exact_quantiles

# Label, truncation unit and length of each measurement window.
SPANS = (("HOURLY", "hour", 1), ("DAILY", "day", 24), ("WEEKLY", "week", 168))


def latency_ms() -> Column:
    micros = F.unix_micros("received_at") - F.unix_micros("event_timestamp")
    return F.floor(micros / 1000)


def _spread(df: DataFrame, clock: str) -> DataFrame:
    """Each row once per granularity, with its window."""
    spans = F.array(
        *[
            F.struct(
                F.lit(label).alias("measurement_window"),
                F.date_trunc(unit, F.col(clock)).alias("window_start"),
                (F.date_trunc(unit, F.col(clock)) + F.expr(f"INTERVAL {hours} HOUR")).alias(
                    "window_end"
                ),
            )
            for label, unit, hours in SPANS
        ]
    )
    return df.select("*", F.inline(spans))


def quality_history(outcomes: DataFrame, gold: DataFrame) -> DataFrame:
    """Quality, volume, warnings, completeness and latency per provider and window.

    Events are first counted per (provider, hour, outcome, latency), so hours,
    days and weeks are all built from that one reduced table.
    """
    passed = F.col("outcome") == "passed"
    base = (
        outcomes.where("outcome <> 'duplicate'")
        .groupBy(
            "provider",
            F.date_trunc("hour", "received_at").alias("hour"),
            F.when(passed, latency_ms()).alias("latency_ms"),
            "outcome",
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(passed & (F.size("injected_faults") > 0)).alias("warnings"),
            F.sum(F.when(passed, validation_points(F.col("injected_faults")))).alias("points"),
        )
    )
    spread = _spread(base, "hour")
    keys = ["provider", "measurement_window", "window_start"]
    totals = spread.groupBy(*keys, "window_end").agg(
        F.sum("n").alias("events_count"),
        F.sum(F.when(F.col("outcome") == "failed", F.col("n")).otherwise(0)).alias("dlq_count"),
        F.sum("warnings").alias("warning_count"),
        F.sum("points").alias("_points"),
        F.sum(F.when(passed, F.col("n"))).alias("_passed"),
        F.sum(F.col("latency_ms") * F.col("n")).alias("_latency"),
    )
    timed = spread.where(F.col("latency_ms").isNotNull()).select(*keys, "latency_ms", "n")
    p99 = exact_quantiles(timed, keys, "latency_ms", {"p99": 0.99})
    completeness = _spread(gold.select("provider", "as_of", "completeness_pct"), "as_of").groupBy(
        *keys
    ).agg(F.round(F.avg("completeness_pct"), 2).alias("completeness_pct"))
    return (
        totals.join(p99, keys, "left")
        .join(completeness, keys, "left")
        .select(
            F.md5(
                F.concat_ws(
                    "|",
                    "provider",
                    "measurement_window",
                    F.unix_seconds("window_start").cast("string"),
                )
            ).alias("quality_history_id"),
            *keys,
            "window_end",
            "events_count",
            "dlq_count",
            "warning_count",
            F.round(F.col("_points") / (F.col("_passed") * 100), 4).alias("quality_score"),
            "completeness_pct",
            F.round(F.col("_latency") / F.col("_passed"), 2).alias("avg_latency_ms"),
            F.round("p99", 2).alias("p99_latency_ms"),
            F.col("window_end").alias("snapshot_time"),
        )
    )
