"""Reporting views and ad-hoc reads over Silver, Gold and the dead-letter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvewright.functions.clock import after

HOUR = 3600
DAY = 86_400


def _share(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part * 100.0 / F.nullif(whole, F.lit(0)), digits)


def latest_curves(gold: DataFrame) -> DataFrame:
    """Latest snapshot per provider, instrument and curve date."""
    newest = Window.partitionBy("provider", "instrument", "curve_date").orderBy(
        F.col("snapshot_time").desc(), F.col("snapshot_id")
    )
    return (
        gold.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    )


def quality_summary(history: DataFrame, as_of: Column) -> DataFrame:
    """Daily quality of the last week per provider, with the change from the day before."""
    daily = (
        history.where(
            (F.col("measurement_window") == "DAILY")
            & (F.col("window_start") >= after(as_of, -7 * DAY))
        )
        .groupBy("provider", F.date_trunc("day", "window_start").alias("quality_date"))
        .agg(
            F.avg("quality_score").alias("_quality"),
            F.sum("events_count").alias("total_events"),
            F.sum("dlq_count").alias("total_dlq"),
            F.sum("warning_count").alias("total_warnings"),
            F.avg("completeness_pct").alias("_completeness"),
            F.avg("avg_latency_ms").alias("_latency"),
            F.max("p99_latency_ms").alias("_p99"),
        )
    )
    # At most seven rows per provider.
    by_day = Window.partitionBy("provider").orderBy("quality_date")
    delta = F.col("_quality") - F.lag("_quality").over(by_day)
    return daily.withColumn("_delta", delta).select(
        "provider",
        "quality_date",
        F.round("_quality", 4).alias("avg_quality_score"),
        "total_events",
        "total_dlq",
        "total_warnings",
        F.round("_completeness", 2).alias("avg_completeness_pct"),
        F.round("_latency", 2).alias("avg_latency_ms"),
        F.round("_p99", 2).alias("max_p99_latency_ms"),
        _share(F.col("total_dlq"), F.col("total_events"), 4).alias("dlq_rate_pct"),
        F.round("_delta", 4).alias("quality_score_delta"),
        F.when(F.col("_delta") > 0.01, "IMPROVING")
        .when(F.col("_delta") < -0.01, "DEGRADING")
        .otherwise("STABLE")
        .alias("trend"),
    )


def dlq_summary(letters: DataFrame, as_of: Column) -> DataFrame:
    """Dead letters per provider and category, recent and resolved."""
    when = F.col("dlq_timestamp")

    def status(name: str) -> Column:
        return F.count_if(F.col("retry_status") == name)

    return letters.groupBy("provider", "failure_category").agg(
        F.count_if(when >= after(as_of, -DAY)).alias("events_last_24h"),
        F.count_if(when >= after(as_of, -7 * DAY)).alias("events_last_7d"),
        F.count(F.lit(1)).alias("events_total"),
        F.min(when).alias("first_seen"),
        F.max(when).alias("last_seen"),
        status("RESOLVED").alias("resolved_count"),
        status("PENDING").alias("pending_count"),
        status("ABANDONED").alias("abandoned_count"),
        _share(status("RESOLVED"), F.count(F.lit(1)), 2).alias("resolution_rate_pct"),
    )


def curve_completeness(gold: DataFrame, as_of: Column) -> DataFrame:
    """Hours of the last day with at least one snapshot, per provider and instrument."""
    recent = gold.where(F.col("snapshot_time") >= after(as_of, -DAY))
    actual = recent.groupBy(
        "provider", "instrument", F.date_trunc("hour", "snapshot_time").alias("slot")
    ).agg(
        F.max("quality_score").alias("best_quality"),
        F.max("completeness_pct").alias("best_completeness"),
    )
    last_slot = F.date_trunc("hour", as_of)
    slots = F.sequence(after(last_slot, -23 * HOUR), last_slot, F.expr("INTERVAL 1 HOUR"))
    expected = (
        recent.select("provider", "instrument")
        .distinct()
        .withColumn("slot", F.explode(slots))
    )
    joined = expected.join(
        actual.withColumn("filled", F.lit(1)), ["provider", "instrument", "slot"], "left"
    )
    filled, total = F.sum(F.coalesce("filled", F.lit(0))), F.count(F.lit(1))
    gap = F.when(F.col("filled").isNull(), F.col("slot"))
    ratio = filled * 100.0 / total
    return joined.groupBy("provider", "instrument").agg(
        total.alias("expected_slots"),
        filled.alias("filled_slots"),
        F.round(ratio, 2).alias("completeness_pct"),
        F.round(F.avg("best_quality"), 4).alias("avg_quality_score"),
        F.round(F.avg("best_completeness"), 2).alias("avg_curve_completeness_pct"),
        F.when(ratio >= 95, "GREEN").when(ratio >= 80, "AMBER").otherwise("RED").alias("rag_status"),
        F.min(gap).alias("first_gap"),
        F.max(gap).alias("last_gap"),
    )


# -- serving reads -----------------------------------------------------------


def curve_list(served: DataFrame) -> DataFrame:
    return served.select(
        "instrument",
        "curve_name",
        "provider",
        "as_of",
        "completeness",
        "tenor_count",
        "version",
        "is_authoritative",
    ).orderBy("instrument")


def curve_get(served: DataFrame, instrument: str) -> DataFrame:
    return served.where(F.col("instrument") == instrument).select(
        "instrument", "curve_name", "as_of", "version", F.inline("tenors")
    )


def curve_history(curves: DataFrame, instrument: str, limit: int = 20) -> DataFrame:
    if not 1 <= limit <= 200:
        raise ValueError("limit must lie in 1..200")
    return (
        curves.where(F.col("instrument") == instrument)
        .withColumn("event_timestamp_ms", F.unix_millis("event_timestamp"))
        .orderBy(F.col("event_timestamp_ms").desc(), F.col("event_id").desc())
        .limit(limit)
    )


def providers(health: DataFrame, provider: str | None = None) -> DataFrame:
    chosen = health if provider is None else health.where(F.col("provider") == provider)
    return chosen.orderBy("provider")


def dlq_stats(letters: DataFrame, limit: int = 20) -> DataFrame:
    """Depth, counts per category and the most recent entries as one tagged table."""
    recent = (
        letters.orderBy(F.col("dlq_timestamp").desc(), F.col("dlq_event_id")).limit(limit)
    )
    counts = letters.groupBy("failure_category").agg(F.count(F.lit(1)).alias("n"))
    text = F.lit(None).cast("string")
    return (
        counts.agg(F.sum("n").alias("n"))
        .select(F.lit("depth").alias("part"), text.alias("label"), F.coalesce("n", F.lit(0)).alias("n"))
        .unionByName(counts.select(F.lit("category").alias("part"), F.col("failure_category").alias("label"), "n"))
        .unionByName(
            recent.select(
                F.lit("recent").alias("part"),
                F.col("dlq_event_id").alias("label"),
                F.unix_micros("dlq_timestamp").alias("n"),
            )
        )
    )


def dlq_list(
    letters: DataFrame,
    limit: int = 20,
    provider: str | None = None,
    category: str | None = None,
    replayed: bool | None = None,
) -> DataFrame:
    """Matching dead letters, newest first, with total and returned counts."""
    chosen = letters
    if provider:
        chosen = chosen.where(F.col("provider") == provider)
    if category:
        chosen = chosen.where(F.col("failure_category") == category)
    if replayed is not None:
        chosen = chosen.where((F.col("retry_status") == "RESOLVED") == F.lit(replayed))
    total = chosen.agg(F.count(F.lit(1))).scalar()
    return (
        chosen.orderBy(F.col("dlq_timestamp").desc(), F.col("dlq_event_id"))
        .limit(limit)
        .withColumn("total", total)
        .withColumn("returned", F.least(F.col("total"), F.lit(limit)))
    )


def dlq_breakdown(letters: DataFrame) -> DataFrame:
    """Totals overall, by category and by provider in one pass."""
    return (
        letters.groupingSets(
            [["failure_category"], ["provider"], []], "failure_category", "provider"
        )
        .agg(
            F.grouping_id().alias("_level"),
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.coalesce(F.col("retry_status"), F.lit("")) != "RESOLVED").alias("unreplayed"),
            F.min("original_received_at").alias("oldest"),
            F.max("original_received_at").alias("newest"),
        )
        .select(
            F.when(F.col("_level") == 1, "category")
            .when(F.col("_level") == 2, "provider")
            .otherwise("all")
            .alias("part"),
            F.when(F.col("_level") == 1, F.col("failure_category"))
            .when(F.col("_level") == 2, F.col("provider"))
            .alias("label"),
            "events",
            "unreplayed",
            "oldest",
            "newest",
        )
    )


# -- warehouse checks --------------------------------------------------------


def silver_profile(silver: DataFrame) -> DataFrame:
    return silver.groupBy("provider", "instrument").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.min("event_timestamp").alias("earliest"),
        F.max("event_timestamp").alias("latest"),
        F.round(F.avg("quality_score"), 3).alias("avg_quality"),
    )


def silver_freshness(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"), F.max("received_at").alias("latest_event")
    )


def quality_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy("instrument", "validation_status").agg(
        F.round(F.avg("quality_score"), 3).alias("avg_quality"),
        F.count(F.lit(1)).alias("event_count"),
    )


def newest_prices(silver: DataFrame, instrument: str, limit: int = 24) -> DataFrame:
    return (
        silver.where(F.col("instrument") == instrument)
        .orderBy(F.col("event_timestamp").desc(), F.col("event_id"))
        .limit(limit)
        .select("tenor", "price", "quality_score", "event_timestamp")
    )


def gold_stats(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count(F.lit(1)).alias("total_snapshots"),
        F.round(F.avg("completeness_pct"), 3).alias("avg_completeness"),
        F.min("as_of").alias("oldest_snapshot"),
        F.max("as_of").alias("newest_snapshot"),
    )


def newest_authoritative(gold: DataFrame, limit: int = 12) -> DataFrame:
    return (
        gold.where("is_authoritative")
        .orderBy(F.col("as_of").desc(), F.col("curve_name"))
        .limit(limit)
        .select(
            "instrument",
            "curve_name",
            "as_of",
            "front_price",
            "num_tenors",
            "completeness_pct",
            "quality_score",
        )
    )


def completeness_histogram(gold: DataFrame) -> DataFrame:
    return gold.groupBy("completeness_pct").agg(F.count(F.lit(1)).alias("snapshots"))


def current_curves(gold: DataFrame) -> DataFrame:
    return latest_curves(gold).select(
        "instrument",
        "curve_date",
        "front_price",
        "num_tenors",
        F.round("quality_score", 3).alias("quality"),
        "completeness_pct",
        "snapshot_time",
        "provider",
    )


def lineage(silver: DataFrame, path_part: str, limit: int = 10) -> DataFrame:
    """Silver rows loaded from Bronze files whose path contains ``path_part``."""
    return (
        silver.where(F.col("bronze_key").contains(path_part))
        .orderBy("event_id")
        .limit(limit)
        .select(
            "event_id",
            "provider",
            "instrument",
            "tenor",
            "price",
            "quality_score",
            "bronze_key",
            "trace_id",
        )
    )


def incomplete_snapshots(gold: DataFrame, start: Column, end: Column) -> DataFrame:
    return gold.where(F.col("as_of").between(start, end) & (F.col("completeness") < 1.0))


def repeated_event_ids(loaded: DataFrame, start: Column, end: Column, limit: int = 20) -> DataFrame:
    """Replayed event ids loaded more than once in a window, most repeated first."""
    return (
        loaded.where(F.col("validated_at").between(start, end) & F.col("is_replay"))
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where("cnt > 1")
        .orderBy(F.col("cnt").desc(), F.col("event_id"))
        .limit(limit)
    )


def repeated_gold_prices(loaded: DataFrame, limit: int = 20) -> DataFrame:
    """(curve, tenor, as_of) combinations present more than once."""
    return (
        loaded.select("curve_name", "as_of", F.explode(F.map_keys("tenors")).alias("tenor"))
        .groupBy("curve_name", "tenor", "as_of")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where("cnt > 1")
        .orderBy(F.col("cnt").desc(), "curve_name", "tenor", "as_of")
        .limit(limit)
    )
