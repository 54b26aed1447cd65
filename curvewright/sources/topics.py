"""Topics: keyed JSON messages in, typed events and undecodable messages out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.functions.clock import utc
from curvewright.functions.payload import JSON_TEXT
from curvewright.functions.pin import pin
from curvewright.schemas import FAULT_TYPES, REPLAY_SOURCES
from curvewright.sources import topic_log

_ENVELOPE = (
    "event_id STRING, provider STRING, instrument STRING, received_at STRING, "
    "event_timestamp STRING, payload VARIANT, injected_faults ARRAY<STRING>, "
    "is_replay BOOLEAN, replay_source STRING, trace_id STRING, _corrupt STRING"
)


def read_topic(
    spark: SparkSession,
    topics: str,
    servers: str | None = None,
    directory: str | None = None,
    stream: bool = True,
    per_trigger: int | None = None,
    log: str | None = None,
    rows_per_second: float | None = None,
    plan: str | None = None,
) -> DataFrame:
    """Messages of ``topics`` from the earliest on: key, value, received_at, arrival_seq.

    With ``servers`` the Kafka source is used (its connector must be on the
    classpath). ``log`` names the root of a topic log, which keeps keys, headers
    and order without a broker; see :func:`topic_log.read_log` for
    ``rows_per_second`` and ``plan``. ``directory`` is for folders of foreign
    JSON-lines files, which have no keys. ``per_trigger`` limits admission per
    micro-batch: offsets for Kafka, files for folders.
    """
    if log:
        made = topic_log.read_log(spark, log, topics, stream, rows_per_second, plan)
        return made.select(
            "topic", "key", "value", F.timestamp_micros("published_us").alias("received_at"),
            (F.col("offset") * 65536 + F.pmod(F.xxhash64("topic"), F.lit(65536))).alias("arrival_seq"),
        )
    reader = spark.readStream if stream else spark.read
    if servers:
        reader = reader.format("kafka").option("kafka.bootstrap.servers", servers)
        reader = reader.option("subscribe", topics).option("startingOffsets", "earliest")
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.load().select(
            F.col("topic"),
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("received_at"),
            # An offset is unique in its partition only.
            (F.col("offset") * 65536 + F.pmod(F.xxhash64("topic", "partition"), F.lit(65536))).alias("arrival_seq"),
        )
    if stream and per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    folders = ",".join(f"{directory}/{t}" for t in topics.split(","))
    path = f"{directory}/{{{topics}}}" if "," in topics else folders
    lines = reader.format("text").load(path)
    return lines.select(
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        "value",
        F.col("_metadata.file_modification_time").alias("received_at"),
        F.xxhash64("value").alias("arrival_seq"),
    )


def decode_all(messages: DataFrame) -> DataFrame:
    """Parse every message; ``error`` says why a message is not an event.

    The envelope's own ``received_at`` wins over the transport's. Absent ids
    are filled with a hash of the message, so a retry fills the same ones.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = pin(
        messages.withColumnRenamed("received_at", "_transport_time"),
        {"m": F.from_json("value", _ENVELOPE, options)},
    )
    kind = F.schema_of_variant("m.payload")
    faults = F.coalesce("m.injected_faults", F.array().cast("array<string>"))
    known = F.array(*[F.lit(name) for name in FAULT_TYPES])
    error = (
        F.when(F.col("m").isNull() | F.col("m._corrupt").isNotNull(), "not a JSON object")
        .when(F.col("m.provider").isNull(), "provider is required")
        .when(F.col("m.instrument").isNull(), "instrument is required")
        .when(utc(F.col("m.event_timestamp")).isNull(), "event_timestamp is not a time")
        .when(
            F.col("m.received_at").isNotNull() & utc(F.col("m.received_at")).isNull(),
            "received_at is not a time",
        )
        .when(~F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False)), "payload is not an object")
        .when(F.size(F.array_except(faults, known)) > 0, "unknown fault type")
        .when(
            F.col("m.replay_source").isNotNull() & ~F.col("m.replay_source").isin(*REPLAY_SOURCES),
            "unknown replay source",
        )
    )
    return pin(parsed, {"error": error}).select(
        "value",
        "error",
        F.coalesce("m.event_id", F.md5("value")).alias("event_id"),
        F.col("m.provider").alias("provider"),
        F.col("m.instrument").alias("instrument"),
        F.coalesce(utc(F.col("m.received_at")), "_transport_time").alias("received_at"),
        utc(F.col("m.event_timestamp")).alias("event_timestamp"),
        F.to_json("m.payload").alias("payload"),
        faults.alias("injected_faults"),
        F.coalesce("m.is_replay", F.lit(False)).alias("is_replay"),
        F.col("m.replay_source").alias("replay_source"),
        F.coalesce("m.trace_id", F.md5(F.concat(F.lit("trace"), "value"))).alias("trace_id"),
        "arrival_seq",
    )


def decode(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, undecodable messages); no message is lost."""
    everything = decode_all(messages)
    return (
        everything.where("error IS NULL").drop("value", "error"),
        everything.where("error IS NOT NULL").select("value", "error", "received_at", "arrival_seq"),
    )


def as_messages(
    rows: DataFrame, key: Column, headers: dict[str, Column] | None = None
) -> DataFrame:
    """Rows as keyed JSON messages with text headers."""
    fields = [c for c in rows.columns if c != "arrival_seq"]
    entries = [
        F.struct(F.lit(name).alias("key"), F.encode(value.cast("string"), "utf-8").alias("value"))
        for name, value in (headers or {}).items()
    ]
    listed = (
        F.array(*entries) if entries else F.array().cast("array<struct<key:string,value:binary>>")
    )
    return rows.select(
        key.cast("string").alias("key"),
        F.to_json(F.struct(*fields), JSON_TEXT).alias("value"),
        listed.alias("headers"),
    )


def raw_messages(raw: DataFrame) -> DataFrame:
    """Raw events keyed by instrument; the payload is nested again."""
    nested = raw.withColumn("payload", F.try_parse_json("payload"))
    return as_messages(
        nested,
        F.col("instrument"),
        {
            "trace_id": F.col("trace_id"),
            "provider": F.col("provider"),
            "has_faults": F.size("injected_faults") > 0,
        },
    )


def dlq_messages(letters: DataFrame) -> DataFrame:
    return as_messages(
        letters,
        F.col("provider"),
        {"trace_id": F.col("trace_id"), "failure_category": F.col("failure_category")},
    )


def curve_messages(curves: DataFrame) -> DataFrame:
    return as_messages(
        curves,
        F.col("curve_name"),
        {"trace_id": F.col("trace_id"), "source_event_id": F.col("source_event_id")},
    )


def write_topic(
    messages: DataFrame, topic: str, servers: str | None = None, directory: str | None = None,
    log: str | None = None, batch: str | None = None,
) -> None:
    """Publish a batch: to Kafka, to a topic log, or as JSON-lines files of the message values.

    A topic log takes a named ``batch`` once.
    """
    if log:
        return topic_log.write_log(messages, log, topic, batch)
    if servers:
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("topic", topic).option("includeHeaders", "true").save()
    else:
        messages.select("value").write.mode("append").text(f"{directory}/{topic}")
