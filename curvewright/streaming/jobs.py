"""The pipeline as Structured Streaming jobs.

Each job reads the table the previous one writes. Results of a micro-batch go
to a folder of their own epoch, written once: a repeated epoch finds them and
leaves them, so the next job, which may have read them, sees no file twice.

Repeats are decided against keyed state, without a watermark: a row that arrives
late is decided like any other and has an outcome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curvewright.operators import gold, normalise, validate
from curvewright.schemas import CURVE_EVENT
from curvewright.sources import files, topics, upserts
from curvewright.sources.tables import silver_rows
from curvewright.streaming.state import CarriedTable, data_driven, flag_repeats_keyed


def _start(stream: DataFrame, work, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _epoch_write(rows: DataFrame, path: str, epoch: int) -> DataFrame:
    """Write an epoch's rows unless they are all there, and go on from the written ones.

    The writer leaves its marker last: a folder without one is what a job that
    died left, and is written anew.
    """
    folder = f"{path}/epoch={epoch}"
    if not files.exists(rows.sparkSession, f"{folder}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def table_stream(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    """Follow a table written epoch by epoch."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path}/epoch=*")


class _Validation:
    """What a micro-batch of events goes through once repeats are flagged."""

    def __init__(self, spark: SparkSession, root: str, window: int):
        self.root, self.window = root, window
        self.scores = CarriedTable(spark, f"{root}/state/scores", "provider")

    def run(self, flagged: DataFrame, letters: DataFrame | None, epoch: int) -> None:
        outcomes = _epoch_write(validate.resolve(flagged), f"{self.root}/outcomes", epoch)
        _epoch_write(validate.validated_events(outcomes), f"{self.root}/validated", epoch)
        dead = validate.dead_letters(outcomes)
        _epoch_write(dead if letters is None else dead.unionByName(letters), f"{self.root}/dlq", epoch)
        rolled = validate.rolling_scores(
            validate.scored_events(outcomes), self.window, start=self.scores.before(epoch)
        )
        self.scores.save(validate.rolling_carry(rolled), epoch)


def validation_job(
    raw: DataFrame,
    root: str,
    every: str | None = None,
    ttl_seconds: int = 3600,
    window: int = 100,
    forget_seconds: int = 86_400,
) -> StreamingQuery:
    """Raw events -> ``outcomes`` (all rows), ``validated``, ``dlq`` and provider scores.

    Anchors are keyed state and expire ``forget_seconds`` after their time to
    live by processing time; a copy that comes later still is accepted anew.
    """
    steps = _Validation(raw.sparkSession, root, window)
    sound = F.col("structure_category").isNull()
    flagged = flag_repeats_keyed(validate.apply_rules(raw), sound, ttl_seconds, forget_seconds)
    with data_driven(raw.sparkSession):
        return _start(flagged, lambda batch, epoch: steps.run(batch, None, epoch), f"{root}/checkpoints/validation", every)


def intake_job(
    messages: DataFrame,
    root: str,
    every: str | None = None,
    ttl_seconds: int = 3600,
    window: int = 100,
    forget_seconds: int = 86_400,
) -> StreamingQuery:
    """Topic messages -> what :func:`validation_job` makes; undecodable ones go to ``dlq``.

    A replay topic is one more name in the reader's list of topics; its
    admission is the reader's ``per_trigger``.
    """
    steps = _Validation(messages.sparkSession, root, window)
    broken = F.col("error").isNotNull()
    everything = topics.decode_all(messages).withColumn("value", F.when(broken, F.col("value")))
    sound = F.col("structure_category").isNull() & ~broken
    flagged = flag_repeats_keyed(validate.apply_rules(everything), sound, ttl_seconds, forget_seconds)

    def work(batch: DataFrame, epoch: int) -> None:
        # Read twice below: state must be computed once in a micro-batch.
        batch = batch.persist()
        letters = batch.where(broken).select("value", "error", "received_at", "arrival_seq")
        steps.run(batch.where(~broken).drop("value", "error"), validate.undecodable_letters(letters), epoch)
        batch.unpersist()

    with data_driven(messages.sparkSession):
        return _start(flagged, work, f"{root}/checkpoints/validation", every)


def normalisation_job(validated: DataFrame, root: str, every: str | None = None) -> StreamingQuery:
    """Validated events -> versioned ``curves`` and the Silver table."""
    spark = validated.sparkSession
    versions = CarriedTable(spark, f"{root}/state/versions", "curve_name")

    def work(batch: DataFrame, epoch: int) -> None:
        curves = normalise.normalise(batch, versions.before(epoch))
        written = _epoch_write(curves, f"{root}/curves", epoch)
        upserts.load_silver(silver_rows(written), f"{root}/silver", f"{root}/staging/silver/{epoch}")
        versions.save(written.groupBy("curve_name").agg(F.max("version").alias("version")), epoch)

    return _start(validated, work, f"{root}/checkpoints/normalisation", every)


def gold_job(
    curves: DataFrame,
    root: str,
    every: str | None = None,
    window_seconds: int = gold.WINDOW_SECONDS,
    write_non_authoritative: bool = False,
) -> StreamingQuery:
    """Curve events -> closed windows -> gated snapshots merged into Gold.

    The watermark trails by two window widths, so all tenors of a window leave
    the aggregation in the same micro-batch.
    """
    spark = curves.sparkSession
    expected = CarriedTable(spark, f"{root}/state/expected", "curve_name")
    prices = gold.tenor_prices(
        curves.withWatermark("event_timestamp", f"{2 * window_seconds} seconds"), window_seconds
    )

    def work(batch: DataFrame, epoch: int) -> None:
        closed = _epoch_write(batch, f"{root}/tenor_prices", epoch)
        windows = gold.with_expected(gold.window_rows(closed), earlier=expected.before(epoch))
        gated = gold.gate(gold.assemble(windows))
        rows = gold.snapshot_rows(gold.with_shape(gold.loadable(gated, write_non_authoritative)))
        upserts.merge_gold(rows, f"{root}/gold", epoch)
        expected.save(
            windows.groupBy("curve_name").agg(F.max("expected_tenors").alias("expected_tenors")),
            epoch,
        )

    return _start(prices, work, f"{root}/checkpoints/gold", every)


VALIDATED_SCHEMA = (
    "event_id string, original_event_id string, provider string, instrument string, "
    "received_at timestamp, event_timestamp timestamp, validated_at timestamp, "
    "corrected_timestamp boolean, payload string, injected_faults array<string>, "
    "is_replay boolean, replay_source string, trace_id string, arrival_seq bigint"
)


def run_available(raw: DataFrame, root: str, window_seconds: int = gold.WINDOW_SECONDS) -> None:
    """Drain what is available through every stage, one after the other."""
    spark = raw.sparkSession
    validation_job(raw, root).awaitTermination()
    validated = table_stream(spark, f"{root}/validated", VALIDATED_SCHEMA)
    normalisation_job(validated, root).awaitTermination()
    curves = table_stream(spark, f"{root}/curves", CURVE_EVENT)
    gold_job(curves, root, window_seconds=window_seconds, write_non_authoritative=True).awaitTermination()
