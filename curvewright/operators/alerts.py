"""Alert rules as tables of evaluations, hold times, grouping and inhibition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvewright.functions.clock import after, floor_to, seconds_between
from curvewright.functions.scores import validation_points
from curvewright.operators.monitor import EPSILON, exact_p95, sliding_sums
from curvewright.operators.ordering import next_arrival


def dlq_ratio(outcomes: DataFrame, window_seconds: int = 60, limit: float = 0.20) -> DataFrame:
    """Windows in which too large a share of a provider's events failed."""
    ratio = F.count_if(F.col("outcome") == "failed") / F.count(F.lit(1))
    return (
        outcomes.groupBy("provider", floor_to(F.col("received_at"), window_seconds).alias("window_start"))
        .agg(ratio.alias("dlq_ratio"))
        .where(F.col("dlq_ratio") > limit)
    )


def low_quality(outcomes: DataFrame, window_seconds: int = 300, limit: float = 0.6) -> DataFrame:
    """Windows whose median score is low; scores are whole hundredths."""
    points = validation_points(F.col("injected_faults"))
    return (
        outcomes.where(F.col("outcome") == "passed")
        .groupBy("provider", floor_to(F.col("received_at"), window_seconds).alias("window_start"))
        .agg((F.percentile(points, 0.5) / 100).alias("quality_p50"))
        .where(F.col("quality_p50") < limit)
    )


def provider_outage(
    events: DataFrame, as_of: Column, silence_seconds: int = 120, hold_seconds: int = 120
) -> DataFrame:
    """Silences long enough to fire, with when the alert starts and ends.

    A provider silent until ``as_of`` is still out: ``ends_at`` is NULL.
    """
    quiet = next_arrival(events, ["provider"], "received_at", "resumed_at")
    return (
        quiet.withColumn(
            "gap_seconds",
            seconds_between(F.coalesce(F.col("resumed_at"), as_of), F.col("received_at")),
        )
        .where(F.col("gap_seconds") > silence_seconds + hold_seconds)
        .select(
            "provider",
            F.col("received_at").alias("last_event_at"),
            after(F.col("received_at"), silence_seconds + hold_seconds).alias("starts_at"),
            F.col("resumed_at").alias("ends_at"),
            "gap_seconds",
        )
    )


def dlq_rate_evaluations(
    letters: DataFrame,
    window_seconds: int,
    slide_seconds: int,
    per_minute_limit: float,
    keys: Sequence[str] = ("provider",),
) -> DataFrame:
    """Dead letters per minute at every evaluation time, and whether that is too many."""
    summed = sliding_sums(
        letters, "dlq_timestamp", keys, {"letters": F.lit(1)}, window_seconds, slide_seconds
    )
    return summed.withColumn(
        "per_minute", F.col("letters") * 60.0 / F.lit(window_seconds)
    ).withColumn("firing", F.col("per_minute") > per_minute_limit)


def dlq_spike(letters: DataFrame, window: int = 300, slide: int = 30, limit: float = 5.0) -> DataFrame:
    return dlq_rate_evaluations(letters, window, slide, limit).where("firing").drop("firing")


def dlq_critical(letters: DataFrame, window: int = 60, slide: int = 30, limit: float = 20.0) -> DataFrame:
    return dlq_rate_evaluations(letters, window, slide, limit).where("firing").drop("firing")


def stale_curves(
    events: DataFrame, as_of: Column, limit_seconds: int = 600, lookback_seconds: int = 900
) -> DataFrame:
    """Instruments seen within the lookback whose last event is too old."""
    newest = (
        events.where(F.col("received_at") > after(as_of, -lookback_seconds))
        .groupBy("instrument", "provider")
        .agg(F.max("received_at").alias("last_event_at"))
    )
    return newest.withColumn(
        "age_seconds", seconds_between(as_of, F.col("last_event_at"))
    ).where(F.col("age_seconds") > limit_seconds)


def malformed_evaluations(
    outcomes: DataFrame, window_seconds: int = 300, slide_seconds: int = 30, limit: float = 0.05
) -> DataFrame:
    bad = F.when(F.col("category") == "malformed", 1).otherwise(0)
    summed = sliding_sums(
        outcomes,
        "received_at",
        ["provider"],
        {"malformed": bad, "ingested": F.lit(1)},
        window_seconds,
        slide_seconds,
    )
    return summed.withColumn(
        "ratio", F.col("malformed") / (F.col("ingested") + F.lit(EPSILON))
    ).withColumn("firing", F.col("ratio") > limit)


def failures_since(
    log: DataFrame, clock: str, outcome: str, as_of: Column, lookback_seconds: int, keys: Sequence[str]
) -> DataFrame:
    """Failed runs of the recent past per key, where there are any."""
    recent = log.where(F.col(clock) > after(as_of, -lookback_seconds))
    return (
        recent.groupBy(*keys)
        .agg(F.count_if(F.col(outcome) == "failed").alias("failures"))
        .where("failures > 0")
    )


def slow_writes(log: DataFrame, window_seconds: int = 300, limit_ms: float = 5000.0) -> DataFrame:
    """Windows whose 95th percentile write time is above the limit."""
    windowed = log.withColumn("window_start", floor_to(F.col("loaded_at"), window_seconds))
    return exact_p95(windowed, ["window_start"], "duration_ms").where(F.col("p95") > limit_ms)


def held(
    evaluations: DataFrame, keys: Sequence[str], step_seconds: int, hold_seconds: int
) -> DataFrame:
    """Stretches of consecutive firing evaluations that last at least the hold time.

    ``evaluations`` has one row per key and evaluation time; a missing
    evaluation ends a stretch. Rows per key are bounded by time over step.
    """
    by_time = Window.partitionBy(*keys).orderBy("eval_time")
    fresh = (
        F.lag("eval_time").over(by_time).isNull()
        | (seconds_between(F.col("eval_time"), F.lag("eval_time").over(by_time)) > step_seconds)
    )
    firing = evaluations.where("firing").withColumn("_fresh", fresh.cast("int"))
    stretches = firing.withColumn("_stretch", F.sum("_fresh").over(by_time))
    return (
        stretches.groupBy(*keys, "_stretch")
        .agg(
            F.min("eval_time").alias("pending_from"),
            F.max("eval_time").alias("ends_at"),
            F.count(F.lit(1)).alias("evaluations"),
        )
        .where(
            seconds_between(F.col("ends_at"), F.col("pending_from")) >= hold_seconds
        )
        .withColumn("starts_at", after(F.col("pending_from"), hold_seconds))
        .drop("_stretch")
    )


def alert_rows(
    firing: DataFrame, name: str, component: str, severity: str, starts: str, ends: str
) -> DataFrame:
    """Any firing table in the common alert form."""
    return firing.select(
        F.lit(name).alias("alertname"),
        F.lit(component).alias("component"),
        F.lit(severity).alias("severity"),
        "provider",
        F.col(starts).alias("starts_at"),
        F.col(ends).alias("ends_at"),
    )


def grouped(alerts: DataFrame) -> DataFrame:
    """One notification per (alertname, component, severity)."""
    return alerts.groupBy("alertname", "component", "severity").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.array_join(F.array_sort(F.collect_set("provider")), ",").alias("providers"),
        F.min("starts_at").alias("first_start"),
        F.max("ends_at").alias("last_end"),
    )


def covered_times(alerts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge overlapping intervals of each key into disjoint ones."""
    by_start = Window.partitionBy(*keys).orderBy("starts_at", "ends_at")
    reach = F.max("ends_at").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    return (
        alerts.withColumn("_reach", reach)
        .withColumn(
            "_new", (F.col("_reach").isNull() | (F.col("starts_at") > F.col("_reach"))).cast("int")
        )
        .withColumn("_run", F.sum("_new").over(by_start))
        .groupBy(*keys, "_run")
        .agg(F.min("starts_at").alias("starts_at"), F.max("ends_at").alias("ends_at"))
        .drop("_run")
    )


def inhibited(alerts: DataFrame, slot_seconds: int = 3600) -> DataFrame:
    """Warnings that no critical alert suppresses, and every critical alert.

    A critical alert suppresses warnings of the same component, or of the same
    name, whose times overlap. Intervals are cut into time slots so that the
    overlap test is an equality on (value, slot) first.
    """
    identity = ["alertname", "component", "provider", "starts_at", "ends_at"]
    warnings = alerts.where("severity = 'warning'")
    critical = alerts.where("severity = 'critical'")

    def slots(df: DataFrame) -> DataFrame:
        first = floor_to(F.col("starts_at"), slot_seconds)
        last = floor_to(F.col("ends_at"), slot_seconds)
        step = F.expr(f"INTERVAL {slot_seconds} SECOND")
        return df.withColumn("_slot", F.explode(F.sequence(first, last, step)))

    suppressed = None
    for column in ("component", "alertname"):
        source = slots(covered_times(critical.select(column, "starts_at", "ends_at"), [column]))
        target = slots(warnings.select(*identity))
        hit = target.alias("w").join(
            source.alias("c"),
            (F.col(f"w.{column}") == F.col(f"c.{column}"))
            & (F.col("w._slot") == F.col("c._slot"))
            & (F.col("w.starts_at") <= F.col("c.ends_at"))
            & (F.col("c.starts_at") <= F.col("w.ends_at")),
            "left_semi",
        ).select(*identity)
        suppressed = hit if suppressed is None else suppressed.unionByName(hit)
    same = None
    for column in identity:
        equal = F.col(f"w.{column}").eqNullSafe(F.col(f"s.{column}"))
        same = equal if same is None else same & equal
    kept = warnings.alias("w").join(suppressed.alias("s"), same, "left_anti")
    return kept.unionByName(critical)


WEBHOOK = T.StructType(
    [
        T.StructField("receiver", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField(
            "alerts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("status", T.StringType()),
                        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
                        T.StructField("annotations", T.MapType(T.StringType(), T.StringType())),
                        T.StructField("startsAt", T.StringType()),
                        T.StructField("endsAt", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)


def flatten(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One row per alert of nested webhook payloads; bad text yields no rows."""
    parsed = payloads.withColumn("_hook", F.from_json(column, WEBHOOK))
    return parsed.select(
        F.col("_hook.receiver").alias("receiver"), F.explode("_hook.alerts").alias("a")
    ).select(
        "receiver",
        F.col("a.labels")["alertname"].alias("alertname"),
        F.col("a.labels")["severity"].alias("severity"),
        F.coalesce("a.status", F.lit("firing")).alias("status"),
        F.col("a.annotations")["summary"].alias("summary"),
        F.col("a.startsAt").try_cast("timestamp").alias("starts_at"),
        F.nullif(F.col("a.endsAt"), F.lit("")).try_cast("timestamp").alias("ends_at"),
    )
