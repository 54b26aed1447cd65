"""Monitoring queries over event, outcome, load and job tables.

``rate(x[w])`` is a count over a window divided by its seconds. Sliding windows
never expand raw rows: rows are first counted in steps of the slide, and only
those few counts are spread over the windows that contain them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvewright.functions.clock import after, floor_to, seconds_between
from curvewright.functions.scores import validation_points
from curvewright.operators.quantiles import exact_quantiles, value_counts

EPSILON = 1e-9


def rate(
    df: DataFrame, clock: str, keys: Sequence[str | Column], window_seconds: int = 60
) -> DataFrame:
    """Rows per second in tumbling windows."""
    return df.groupBy(
        floor_to(F.col(clock), window_seconds).alias("window_start"), *keys
    ).agg(
        F.count(F.lit(1)).alias("events"),
        (F.count(F.lit(1)) / F.lit(window_seconds)).alias("per_second"),
    )


def sliding_sums(
    df: DataFrame,
    clock: str,
    keys: Sequence[str],
    sums: dict[str, Column],
    window_seconds: int,
    slide_seconds: int,
) -> DataFrame:
    """Sums of ``sums`` over windows ending at every multiple of the slide.

    ``eval_time`` is the window's end, exclusive.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    steps = df.groupBy(*keys, floor_to(F.col(clock), slide_seconds).alias("_step")).agg(
        *[F.sum(expr).alias(name) for name, expr in sums.items()]
    )
    ends = F.sequence(
        after(F.col("_step"), slide_seconds),
        after(F.col("_step"), window_seconds),
        F.expr(f"INTERVAL {slide_seconds} SECOND"),
    )
    return (
        steps.withColumn("eval_time", F.explode(ends))
        .groupBy(*keys, "eval_time")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )


def pass_rate(outcomes: DataFrame, window_seconds: int = 120) -> DataFrame:
    return outcomes.groupBy(
        floor_to(F.col("received_at"), window_seconds).alias("window_start"), "provider"
    ).agg(
        (
            100.0
            * F.count_if(F.col("outcome") == "passed")
            / (F.count(F.lit(1)) + F.lit(EPSILON))
        ).alias("pass_rate_pct")
    )


def lag(head: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages behind the head per topic partition, with its severity."""
    behind = F.greatest(F.lit(0), F.col("head_offset") - F.coalesce("committed_offset", F.lit(0)))
    return (
        head.join(committed, ["topic", "topic_partition"], "left")
        .withColumn("lag", behind)
        .withColumn(
            "severity",
            F.when(F.col("lag") > 50_000, "critical")
            .when(F.col("lag") > 10_000, "warning")
            .otherwise("ok"),
        )
        .select("topic", "topic_partition", "lag", "severity")
    )


def mean_quality(scored: DataFrame, window_seconds: int = 300) -> DataFrame:
    points = validation_points(F.col("injected_faults"))
    return scored.groupBy(
        floor_to(F.col("received_at"), window_seconds).alias("window_start"), "provider"
    ).agg((F.sum(points) / (F.count(F.lit(1)) * 100)).alias("avg_quality"))


def exact_p95(timed: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return exact_quantiles(value_counts(timed, keys, value), keys, value, {"p95": 0.95})


def bucket_quantile(histogram: DataFrame, keys: Sequence[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket.

    A rank in the unbounded bucket yields the highest finite bound.
    """
    by_bound = Window.partitionBy(*keys).orderBy("le")
    unbounded = F.col("le") == float("inf")
    ranked = (
        histogram.withColumn("_low", F.coalesce(F.lag("le").over(by_bound), F.lit(0.0)))
        .withColumn("_under", F.coalesce(F.lag("events").over(by_bound), F.lit(0)))
        .withColumn("_total", F.max("events").over(Window.partitionBy(*keys)))
        .withColumn("_rank", F.lit(q) * F.col("_total"))
        .where((F.col("events") >= F.col("_rank")) & (F.col("_under") < F.col("_rank")))
    )
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * (
        F.col("_rank") - F.col("_under")
    ) / (F.col("events") - F.col("_under"))
    return ranked.select(
        *keys, F.when(unbounded, F.col("_low")).otherwise(inside).alias("quantile")
    )


def file_rate(rows: DataFrame, clock: str, path: str, window_seconds: int) -> DataFrame:
    """Distinct files written per second; paths are combined before they move."""
    files = rows.groupBy(
        floor_to(F.col(clock), window_seconds).alias("window_start"), path
    ).agg(F.count(F.lit(1)).alias("rows"))
    return files.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("files"),
        (F.count(F.lit(1)) / F.lit(window_seconds)).alias("per_second"),
    )


def fault_mix(events: DataFrame, window_seconds: int = 300) -> DataFrame:
    """Injected faults per second by type and provider; repeats in a list count."""
    return rate(
        events.withColumn("fault", F.explode("injected_faults")),
        "received_at",
        ["provider", "fault"],
        window_seconds,
    )


def dlq_depth(letters: DataFrame, resolve_after_seconds: int = 3600) -> DataFrame:
    """Unresolved dead letters per provider after every minute with a change."""
    entered = F.struct(F.col("dlq_timestamp").alias("at"), F.lit(1).alias("change"))
    left = F.struct(
        after(F.col("dlq_timestamp"), resolve_after_seconds).alias("at"), F.lit(-1).alias("change")
    )
    changes = F.when(F.col("retry_status") == "RESOLVED", F.array(entered, left)).otherwise(
        F.array(entered)
    )
    per_minute = (
        letters.select("provider", F.inline(changes))
        .groupBy("provider", floor_to(F.col("at"), 60).alias("minute"))
        .agg(F.sum("change").alias("change"))
    )
    # One row per minute: bounded by the time span, not by the event rate.
    so_far = (
        Window.partitionBy("provider")
        .orderBy("minute")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return per_minute.withColumn("depth", F.sum("change").over(so_far))


def duration_stats(
    log: DataFrame, keys: Sequence[str], duration: str, sums: dict[str, str]
) -> DataFrame:
    """Count, sums and duration quantiles per key."""
    totals = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), *[F.sum(src).alias(name) for name, src in sums.items()]
    )
    quantiles = exact_quantiles(
        value_counts(log, keys, duration), keys, duration, {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )
    return totals.join(quantiles, list(keys), "left")


def triage(health: DataFrame, quality: DataFrame, as_of: Column) -> DataFrame:
    """Each provider healthy, concerning or in between on five signals."""
    joined = health.join(quality.drop("events"), "provider", "left")
    age = seconds_between(as_of, F.col("last_event_at"))

    def verdict(good: Column, bad: Column) -> Column:
        return F.when(bad, "concerning").when(good, "healthy").otherwise("watch")

    return joined.select(
        "provider",
        verdict(F.col("status") == "healthy", F.col("status").isin("degraded", "outage")).alias(
            "status_check"
        ),
        verdict(F.col("events_last_60s") > 0, F.col("events_last_60s") == 0).alias("volume_check"),
        verdict(F.col("dlq_rate") < 0.05, F.col("dlq_rate") > 0.20).alias("dlq_check"),
        verdict(F.col("quality_p50") > 0.90, F.col("quality_p50") < 0.60).alias("quality_check"),
        verdict(age <= 300, age > 600).alias("age_check"),
    )
