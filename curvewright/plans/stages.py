"""The stages composed over the derived feed, for queries and tests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.operators import alerts, gold, normalise, validate
from curvewright.plans.inputs import query_clock, raw_market_events
from curvewright.session import configure, fresh_path
from curvewright.sources.tables import silver_rows
from curvewright.sources.upserts import staged

DAY = 86_400


@dataclass(frozen=True)
class Stages:
    """Lazy tables of one input folder; nothing runs until a result is used."""

    spark: SparkSession
    sf_dir: str
    outcomes_path: str | None = None

    def __post_init__(self) -> None:
        configure(self.spark)

    @cached_property
    def raw(self) -> DataFrame:
        return raw_market_events(self.spark, self.sf_dir)

    @cached_property
    def as_of(self) -> Column:
        return query_clock(self.raw)

    @cached_property
    def outcomes(self) -> DataFrame:
        if self.outcomes_path:
            return self.spark.read.parquet(self.outcomes_path)
        return validate.validate(self.raw)

    @cached_property
    def kept(self) -> Stages:
        """The same stages over a written outcome table.

        For results that need outcomes more than once: writing them once to the
        shared folder is cheaper than validating twice, and a lost executor
        repeats only what follows.
        """
        if self.outcomes_path:
            return self
        path = fresh_path(self.spark, "outcomes")
        self.outcomes.write.parquet(path)
        return Stages(self.spark, self.sf_dir, path)

    @cached_property
    def validated(self) -> DataFrame:
        return validate.validated_events(self.outcomes)

    @cached_property
    def dead_letters(self) -> DataFrame:
        return validate.dead_letters(self.outcomes)

    @cached_property
    def interpreted(self) -> DataFrame:
        return normalise.interpret(self.validated)

    @cached_property
    def curves(self) -> DataFrame:
        """Versioned curve events; numbering reads its input twice, so it is written first."""
        rows = staged(self.curves_unversioned, fresh_path(self.spark, "curve-rows"))
        return normalise.with_versions(rows)

    @cached_property
    def curves_unversioned(self) -> DataFrame:
        """Curve events without the version column's ordering work."""
        return normalise.curve_rows(self.interpreted)

    @cached_property
    def windows(self) -> DataFrame:
        return gold.window_rows(gold.tenor_prices(self.curves, DAY))

    @cached_property
    def snapshots(self) -> DataFrame:
        return gold.assemble(gold.with_expected(self.windows))

    @cached_property
    def gold(self) -> DataFrame:
        return gold.gold_table(self.curves, DAY, stale_after_seconds=12 * 3600)

    @cached_property
    def silver(self) -> DataFrame:
        return silver_rows(self.curves)

    @cached_property
    def silver_unversioned(self) -> DataFrame:
        """Silver for reads that do not look at versions."""
        return silver_rows(self.curves_unversioned.withColumn("version", F.lit(0).cast("bigint")))

    @cached_property
    def dlq_table(self) -> DataFrame:
        """Dead letters with the retry state derived from the event number."""
        number = F.expr("arrival_seq div 2")
        states = F.array(*[F.lit(s) for s in ("PENDING", "RETRYING", "RESOLVED", "ABANDONED")])
        return self.dead_letters.withColumn(
            "retry_count", F.pmod(number, F.lit(4)).cast("int")
        ).withColumn("retry_status", F.element_at(states, F.col("retry_count") + 1))

    @cached_property
    def load_log(self) -> DataFrame:
        """One load per layer, provider and hour of arrival; durations follow the row count."""
        per_hour = self.raw.groupBy(
            "provider", F.date_trunc("hour", "received_at").alias("loaded_at")
        ).agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.length("payload")).alias("bytes"),
        )
        layers = F.array(
            *[
                F.struct(F.lit(name).alias("layer"), F.lit(factor).alias("factor"))
                for name, factor in (("bronze", 1), ("silver", 2), ("gold", 3))
            ]
        )
        slot = F.expr("unix_seconds(loaded_at) div 3600")
        return per_hour.select("*", F.inline(layers)).select(
            "layer",
            "provider",
            "loaded_at",
            "rows",
            "bytes",
            (F.col("rows") * 137 * F.col("factor") + slot % 11 * 400).alias("duration_ms"),
            F.when((slot + F.col("factor")) % 23 == 0, "failed").otherwise("success").alias("outcome"),
        )

    @cached_property
    def replay_jobs(self) -> DataFrame:
        """One replay job per day and provider, covering that day."""
        day = F.date_trunc("day", "received_at")
        jobs = self.raw.where("provider <> ''").groupBy("provider", day.alias("start_time")).agg(
            F.count(F.lit(1)).alias("events_to_replay")
        )
        number = F.dayofmonth("start_time")
        states = F.array(*[F.lit(s) for s in ("completed", "failed", "running", "pending")])
        sources = F.array(*[F.lit(s) for s in ("bronze_s3", "dlq", "databento_historical")])
        return jobs.select(
            F.concat_ws("-", F.lit("job"), "provider", F.date_format("start_time", "yyyyMMdd")).alias(
                "job_id"
            ),
            F.element_at(sources, number % 3 + 1).alias("source"),
            "provider",
            "start_time",
            (F.col("start_time") + F.expr("INTERVAL 1 DAY")).alias("end_time"),
            (F.col("start_time") + F.expr("INTERVAL 30 HOUR")).alias("requested_at"),
            F.element_at(states, number % 4 + 1).alias("status"),
            "events_to_replay",
            (F.col("events_to_replay") - F.when(number % 5 == 0, 3).otherwise(0)).alias(
                "events_replayed"
            ),
            (F.col("events_to_replay") * 20 + number * 1000).alias("duration_ms"),
        )

    @cached_property
    def alert_clock(self) -> Column:
        """When alerts are looked at: six hours after the feed's last event."""
        return self.as_of + F.expr("INTERVAL 6 HOUR")

    @cached_property
    def alerts(self) -> DataFrame:
        """Alerts of four rules over the derived feed, in the common form."""
        if not self.outcomes_path:
            return self.kept.alerts
        hour = 3600
        spike = alerts.held(
            alerts.dlq_rate_evaluations(self.dead_letters, 6 * hour, hour, 0.004),
            ["provider"],
            hour,
            hour,
        )
        critical = alerts.held(
            alerts.dlq_rate_evaluations(self.dead_letters, 12 * hour, hour, 0.006),
            ["provider"],
            hour,
            0,
        )
        malformed = alerts.held(
            alerts.malformed_evaluations(self.outcomes, 6 * hour, hour, 0.05),
            ["provider"],
            hour,
            hour,
        )
        # One that still lasts counts as lasting until now.
        outage = alerts.provider_outage(self.raw, self.alert_clock, 4 * hour, 600).withColumn(
            "ends_at", F.coalesce("ends_at", self.alert_clock)
        )
        return (
            alerts.alert_rows(spike, "DLQSpike", "validation", "warning", "starts_at", "ends_at")
            .unionByName(
                alerts.alert_rows(
                    critical, "DLQCritical", "validation", "critical", "starts_at", "ends_at"
                )
            )
            .unionByName(
                alerts.alert_rows(
                    malformed, "HighMalformedRate", "feed", "warning", "starts_at", "ends_at"
                )
            )
            .unionByName(
                alerts.alert_rows(
                    outage, "ProviderOutage", "feed", "critical", "starts_at", "ends_at"
                )
            )
        )
