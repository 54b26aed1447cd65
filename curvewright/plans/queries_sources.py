"""Source, sink, load and replay queries. Tables are really written and read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvewright.functions.payload import JSON_TEXT
from curvewright.functions.pin import pin
from curvewright.operators import replay, validate
from curvewright.plans import queries_monitor  # noqa: F401
from curvewright.plans.inputs import table
from curvewright.plans.oracle_ctes import define
from curvewright.plans.registry import query, r6
from curvewright.plans.stages import Stages
from curvewright.session import fresh_path
from curvewright.sources import bronze, landing, topics, upserts, vendor

FROM = datetime(2024, 1, 5, 6, 30, tzinfo=timezone.utc)
TO = datetime(2024, 1, 8, 18, 0, tzinfo=timezone.utc)
_BETWEEN = "BETWEEN TIMESTAMP '2024-01-05 06:30:00' AND TIMESTAMP '2024-01-08 18:00:00'"


def messages(st: Stages) -> DataFrame:
    """Raw events as topic messages, some of them broken."""
    number = F.expr("arrival_seq div 2")
    nested = st.raw.withColumn("payload", F.try_parse_json("payload")).withColumn(
        "injected_faults",
        F.when(number % 313 == 0, F.array(F.lit("gremlin"))).otherwise(F.col("injected_faults")),
    )
    text = F.col("text")
    return pin(nested, {"text": validate.raw_document()}).select(
        F.when(number % 307 == 0, F.substring(text, 1, 40))
        .when(number % 311 == 0, F.regexp_replace(text, r'"payload":\{.*\},"inj', '"payload":5,"inj'))
        .otherwise(text)
        .alias("value"),
        "received_at",
        "arrival_seq",
    )


define("w_message", """
SELECT *, CASE WHEN e % 307 = 0 THEN 'not a JSON object' WHEN e % 311 = 0 THEN 'payload is not an object'
  WHEN e % 313 = 0 THEN 'unknown fault type' END AS error FROM w_raw
""")
define("w_bar", """
SELECT *, l_orderkey * 10 + l_linenumber AS seq,
  l_shipdate::TIMESTAMP + to_microseconds(((l_orderkey * 10 + l_linenumber) * 7919) % 86399999989) AS traded_at,
  CASE WHEN l_suppkey % 2 = 0 THEN 'BRENT' ELSE 'WTI' END AS instrument,
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 THEN ''
       WHEN l_suppkey % 2 = 0 THEN 'BRN' ELSE 'CL' END AS symbol,
  CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE l_extendedprice END AS close
FROM lineitem
""")


def _trade_nanos():
    """Nanoseconds of the ship date plus an odd part of a day."""
    seq = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.pmod(seq * 7919, F.lit(86_399_999_989))
    return micros * 1000 + F.pmod(seq, F.lit(1000))


def bars(st: Stages) -> DataFrame:
    """Exported vendor bars in the shape of ``lineitem``."""
    even = F.col("l_suppkey") % 2 == 0

    def fixed(price):
        return F.round(price * 1e9).cast("bigint")

    close = F.when(F.col("l_partkey") % 50 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    return table(st.spark, st.sf_dir, "lineitem").select(
        F.when(even, "BRENT").otherwise("WTI").alias("instrument"),
        _trade_nanos().alias("ts_event"),
        fixed(F.col("l_extendedprice")).alias("open"),
        fixed(F.col("l_extendedprice") * 2).alias("high"),
        fixed(F.col("l_extendedprice") / 2).alias("low"),
        fixed(close).alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.when(F.col("l_linenumber") == 6, F.lit(None))
        .when(F.col("l_linenumber") == 5, "")
        .when(even, "BRN")
        .otherwise("CL")
        .alias("symbol"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("arrival_seq"),
    )


def trades(st: Stages) -> DataFrame:
    """Exported vendor trades: the bars' times and prices with instrument ids."""
    return bars(st).select(
        "ts_event",
        F.when(F.col("arrival_seq") % 10 == 6, F.lit(None).cast("string"))
        .otherwise(F.nullif(F.col("symbol"), F.lit("")))
        .alias("symbol"),
        F.when(F.col("arrival_seq") % 10 == 6, F.lit(None).cast("bigint"))
        .otherwise(F.col("arrival_seq") % 1000)
        .alias("instrument_id"),
        F.col("close").alias("price"),
        F.col("volume").alias("size"),
        "arrival_seq",
    )


# -- topics ------------------------------------------------------------------


@query("src_topic", "SELECT count(*) AS messages, count(DISTINCT seq) AS distinct_messages FROM w_raw")
def src_topic(st: Stages):
    root = fresh_path(st.spark, "topic")
    topics.write_topic(topics.raw_messages(st.raw), "raw", directory=root)
    read = topics.read_topic(st.spark, "raw", directory=root, stream=False)
    return read.agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("value").alias("distinct_messages")
    )


@query("src_decode", """
SELECT seq AS arrival_seq, event_id, provider, instrument, received_at, event_timestamp,
  array_to_string(faults, ',') AS faults, trace_id, CAST(price AS DOUBLE) AS price
FROM w_message WHERE error IS NULL
""")
def src_decode(st: Stages):
    events, _ = topics.decode(messages(st))
    return events.select(
        "arrival_seq",
        "event_id",
        "provider",
        "instrument",
        "received_at",
        "event_timestamp",
        F.array_join("injected_faults", ",").alias("faults"),
        "trace_id",
        F.get_json_object("payload", "$.price").try_cast("double").alias("price"),
    )


@query("dlq_decode", """
SELECT seq AS arrival_seq, 'unknown' AS provider, 'schema_violation' AS failure_category,
  'Deserialisation failed: ' || error AS failure_reason, received_at AS dlq_timestamp
FROM w_message WHERE error IS NOT NULL
""")
def dlq_decode(st: Stages):
    _, broken = topics.decode(messages(st))
    # The transport's arrival time of a broken message is its received_at here.
    return validate.undecodable_letters(broken).select(
        "arrival_seq", "provider", "failure_category", "failure_reason", "dlq_timestamp"
    )


@query("dlq_unexpected", """
SELECT 'unknown' AS failure_category, 'unknown' AS provider,
  'Unexpected processing error: ' || error AS failure_reason, count(*) AS letters
FROM w_message WHERE error IS NOT NULL GROUP BY error
""")
def dlq_unexpected(st: Stages):
    _, broken = topics.decode(messages(st))
    return (
        validate.unexpected_letters(broken)
        .groupBy("failure_category", "provider", "failure_reason")
        .agg(F.count(F.lit(1)).alias("letters"))
    )


@query("sink_topic", """
SELECT curve_name AS key, count(*) AS messages, count(DISTINCT trace_id) AS traces,
  CAST(max(version) AS BIGINT) AS last_version
FROM w_curve GROUP BY curve_name
""")
def sink_topic(st: Stages):
    root = fresh_path(st.spark, "topic")
    topics.write_topic(topics.curve_messages(st.curves), "normalized", directory=root)
    read = topics.read_topic(st.spark, "normalized", directory=root, stream=False)
    return read.groupBy(F.get_json_object("value", "$.curve_name").alias("key")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.countDistinct(F.get_json_object("value", "$.trace_id")).alias("traces"),
        F.max(F.get_json_object("value", "$.version").cast("bigint")).alias("last_version"),
    )


# -- Bronze ------------------------------------------------------------------


def written_bronze(st: Stages) -> DataFrame:
    """Bronze of the feed; the nameless provider gets a folder of its own."""
    root = fresh_path(st.spark, "bronze")
    named = st.raw.withColumn(
        "provider", F.when(F.col("provider") == "", "unnamed").otherwise(F.col("provider"))
    )
    bronze.write_bronze(named, root)
    return bronze.read_bronze(st.spark, root)


@query("bronze_write", """
SELECT CASE provider WHEN '' THEN 'unnamed' ELSE provider END AS provider,
  strftime(received_at, '%Y-%m-%d') AS dt, strftime(received_at, '%H') AS hh, count(*) AS events
FROM w_raw GROUP BY ALL
""")
def bronze_write(st: Stages):
    return written_bronze(st).groupBy("provider", "dt", "hh").agg(
        F.count(F.lit(1)).alias("events")
    )


@query("bronze_sanitise", """
SELECT seq AS arrival_seq, '[' || array_to_string(list_transform(faults, lambda f: '"' || f || '"'), ',')
  || ']' AS injected_faults FROM w_raw
""")
def bronze_sanitise(st: Stages):
    return bronze.sanitise(st.raw).select("arrival_seq", "injected_faults")


@query("bronze_scan", f"""
SELECT seq AS arrival_seq, received_at FROM w_raw
WHERE provider = 'provider-a' AND date_trunc('hour', received_at) >= TIMESTAMP '2024-01-05 06:00:00'
  AND date_trunc('hour', received_at) <= TIMESTAMP '2024-01-08 18:00:00'
""")
def bronze_scan(st: Stages):
    return bronze.scan_manifest(st.spark, bronze_root(st), "provider-a", FROM, TO).select(
        "arrival_seq", "received_at"
    )


@query("bronze_reinflate", """
SELECT seq AS arrival_seq, CAST(len(faults) AS BIGINT) AS faults, true AS payload_is_object FROM w_raw
""")
def bronze_reinflate(st: Stages):
    stored = bronze.json_values(bronze.sanitise(st.raw), ["payload"])
    back = bronze.reinflate(stored)
    return back.select(
        "arrival_seq",
        F.size("injected_faults").alias("faults"),
        F.startswith(F.schema_of_variant("payload_value"), F.lit("OBJECT")).alias(
            "payload_is_object"
        ),
    )


# -- loads -------------------------------------------------------------------


@query("silver_load", """
SELECT event_id, curve_name, tenor, CAST(price AS DOUBLE) AS price, CAST(version AS BIGINT) AS version,
  strftime(event_timestamp, '%Y-%m-%d') AS curve_date
FROM w_curve
""")
def silver_load(st: Stages):
    path = fresh_path(st.spark, "silver")
    rows = upserts.staged(st.silver, fresh_path(st.spark, "staging"))
    # Two overlapping batches: the second repeats half of the first.
    upserts.load_silver(rows.where(F.dayofmonth("event_timestamp") <= 20), path, fresh_path(st.spark, "staging"))
    upserts.load_silver(rows.where(F.dayofmonth("event_timestamp") > 10), path, fresh_path(st.spark, "staging"))
    return st.spark.read.parquet(path).select(
        "event_id", "curve_name", "tenor", "price", "version", F.col("curve_date").cast("date")
    )


@query("gold_merge", """
SELECT curve_name, as_of, CAST(version AS BIGINT) AS version, round(front_price, 6) AS front_price,
  CASE WHEN day(as_of) BETWEEN 11 AND 20 THEN 'rewritten' ELSE 'once' END AS history
FROM w_gold
""")
def gold_merge(st: Stages):
    path = fresh_path(st.spark, "gold")
    keyed = upserts.staged(st.gold, fresh_path(st.spark, "staging"))
    first = keyed.where(F.dayofmonth("as_of") <= 20).withColumn("history", F.lit("once"))
    again = keyed.where(F.dayofmonth("as_of") > 10).withColumn(
        "history", F.when(F.dayofmonth("as_of") <= 20, "rewritten").otherwise("once")
    )
    upserts.merge_gold(first, path)
    upserts.merge_gold(again, path)
    return upserts.gold_table(st.spark, path).read().select(
        "curve_name", "as_of", "version", r6("front_price"), "history"
    )


def _documents(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*"), JSON_TEXT).alias("document"))


@query("silver_pipe", """
SELECT event_id, provider, instrument, strftime(event_timestamp, '%Y-%m-%d') AS curve_date, tenor,
  price, currency, unit, validation_status, CAST(quality_score AS DOUBLE) AS quality_score,
  event_timestamp, bronze_key AS bronze_s3_key, trace_id, NULL::VARCHAR AS venue
FROM w_silver
""")
def silver_pipe(st: Stages):
    documents = _documents(
        st.silver_unversioned.withColumnRenamed("bronze_key", "bronze_s3_key").withColumn(
            "venue", F.lit("null")
        )
    )
    return landing.silver_pipe(documents).select(
        "event_id",
        "provider",
        "instrument",
        "curve_date",
        "tenor",
        "price",
        "currency",
        "unit",
        "validation_status",
        "quality_score",
        "event_timestamp",
        "bronze_s3_key",
        "trace_id",
        "venue",
    )


@query("dlq_pipe", """
SELECT dlq_event_id, original_event_id, provider, failure_category, dlq_timestamp,
  CASE WHEN retry_count = 3 THEN 0 ELSE retry_count END AS retry_count, retry_status, trace_id
FROM w_dlq_table
""")
def dlq_pipe(st: Stages):
    unfinished = F.when(F.col("retry_count") < 3, F.col("retry_count"))
    documents = _documents(
        st.dlq_table.withColumn("retry_count", unfinished).drop("raw_payload", "arrival_seq")
    )
    # An empty id is one of the texts that mean NULL.
    return landing.dlq_pipe(documents).select(
        "dlq_event_id",
        F.coalesce("original_event_id", F.lit("")).alias("original_event_id"),
        F.coalesce("provider", F.lit("")).alias("provider"),
        "failure_category",
        "dlq_timestamp",
        "retry_count",
        "retry_status",
        "trace_id",
    )


@query("gold_pipe", """
SELECT snapshot_id, provider, instrument, strftime(curve_date, '%Y-%m-%d') AS curve_date,
  CAST(num_tenors AS BIGINT) AS num_tenors, stale_tenors, CAST(0 AS BIGINT) AS outlier_tenors, snapshot_time
FROM w_gold
""")
def gold_pipe(st: Stages):
    documents = _documents(st.gold.drop("tenors", "outlier_tenors"))
    return landing.gold_pipe(documents).select(
        "snapshot_id",
        "provider",
        "instrument",
        "curve_date",
        "num_tenors",
        "stale_tenors",
        "outlier_tenors",
        "snapshot_time",
    )


@query("quality_pipe", """
SELECT nullif(provider, '') AS provider, measurement_window, window_start, window_end, events_count,
  dlq_count, warning_count, quality_score FROM w_history
""")
def quality_pipe(st: Stages):
    from curvewright.operators.quality import quality_history

    # The nameless provider's empty text is one of those that mean NULL.
    rows = quality_history(st.kept.outcomes, st.kept.gold)
    return landing.quality_pipe(_documents(rows)).select(
        "provider",
        "measurement_window",
        "window_start",
        "window_end",
        "events_count",
        "dlq_count",
        "warning_count",
        "quality_score",
    )


@query("json_landing", """
SELECT dlq_event_id, failure_category, NULL::VARCHAR AS venue FROM w_dlq
""")
def json_landing(st: Stages):
    path = fresh_path(st.spark, "landing")
    rows = st.dead_letters.select("dlq_event_id", "failure_category", F.lit("NULL").alias("venue"))
    # One outer array per category and id prefix keeps every array small.
    entry = F.struct("dlq_event_id", "failure_category", "venue")
    arrays = rows.groupBy(
        "failure_category", F.substring("dlq_event_id", 1, 3).alias("part")
    ).agg(F.to_json(F.collect_list(entry)).alias("value"))
    arrays.select("value").write.option("compression", "gzip").text(path)
    texts = landing.documents_of_arrays(st.spark.read.text(path))
    shape = "dlq_event_id STRING, failure_category STRING, venue STRING"
    parsed = texts.select(F.from_json("document", shape).alias("d"))
    return parsed.select(
        *[
            landing.null_if(F.col(f"d.{c}")).alias(c)
            for c in ("dlq_event_id", "failure_category", "venue")
        ]
    )


# -- vendor data -------------------------------------------------------------


@query("vendor_bars", """
SELECT seq AS arrival_seq, instrument, traded_at AS event_timestamp, round(close, 4) AS price,
  CASE WHEN symbol = '' THEN 'M+1' WHEN symbol IS NULL THEN
    CASE instrument WHEN 'BRENT' THEN 'BRN' ELSE 'CL' END ELSE symbol END AS tenor,
  CASE instrument WHEN 'BRENT' THEN 'BRENT_CRUDE_FORWARD' ELSE 'WTI_CRUDE_FORWARD' END AS curve_name,
  CAST(l_quantity AS BIGINT) AS volume
FROM w_bar WHERE close <> 0
""")
def vendor_bars(st: Stages):
    shape = "price DOUBLE, tenor STRING, curve_name STRING, volume BIGINT"
    events = vendor.bar_events(bars(st)).withColumn("p", F.from_json("payload", shape))
    return events.select(
        "arrival_seq",
        "instrument",
        "event_timestamp",
        "p.price",
        "p.tenor",
        "p.curve_name",
        "p.volume",
    )


@query("vendor_trades", """
SELECT seq AS arrival_seq, 'vendor-x' AS provider,
  CASE WHEN l_linenumber = 6 THEN 'WTI' WHEN l_linenumber = 5 THEN CAST(seq % 1000 AS VARCHAR)
       ELSE symbol END AS instrument,
  traded_at AS event_timestamp, CAST(l_quantity AS BIGINT) AS size, 'databento_historical' AS replay_source
FROM w_bar
""")
def vendor_trades(st: Stages):
    events = vendor.trade_events(
        trades(st), "job-v", F.lit("2024-02-01").cast("timestamp"), "vendor-x", "WTI"
    )
    return events.select(
        "arrival_seq",
        "provider",
        "instrument",
        "event_timestamp",
        F.get_json_object("payload", "$.size").cast("bigint").alias("size"),
        "replay_source",
    )


@query("feed_union", """
SELECT instrument, count(*) AS events FROM w_raw
WHERE instrument IN ('CL', 'EUA') OR instrument NOT IN
  (SELECT DISTINCT instrument FROM w_raw WHERE instrument IN ('CL', 'EUA'))
GROUP BY instrument
""")
def feed_union(st: Stages):
    primary = st.raw.where("instrument IN ('CL', 'EUA')")
    return vendor.feed_union(primary, st.raw).groupBy("instrument").agg(
        F.count(F.lit(1)).alias("events")
    )


# -- replay ------------------------------------------------------------------

_CLOCK = "2024-02-01 00:00:00"


def _now():
    return F.lit(_CLOCK).cast("timestamp")


_written: dict[tuple[str, str], str] = {}


def bronze_root(st: Stages) -> str:
    """The folder of the feed's Bronze, written once a session."""
    of = (st.spark.sparkContext.applicationId, st.sf_dir)
    if of not in _written:
        path = fresh_path(st.spark, "bronze")
        bronze.write_bronze(st.raw, path)
        _written[of] = path
    return _written[of]


def _bronze_frame(st: Stages) -> DataFrame:
    """The feed's Bronze, read back by folder."""
    return bronze.read_bronze(st.spark, bronze_root(st))


@query("replay_bronze", f"""
SELECT seq AS arrival_seq, md5('job-b|' || event_id || '|' || seq) AS event_id, instrument,
  event_timestamp, true AS is_replay, 'bronze_s3' AS replay_source
FROM w_raw WHERE provider = 'provider-a' AND instrument = 'TTF' AND event_timestamp {_BETWEEN}
  AND date_trunc('hour', received_at) BETWEEN
    date_trunc('hour', TIMESTAMP '2024-01-05 06:30:00' - INTERVAL 5 MINUTE)
    AND date_trunc('hour', TIMESTAMP '2024-01-08 18:00:00' + INTERVAL 24 HOUR)
""")
def replay_bronze(st: Stages):
    return replay.replay_bronze(
        _bronze_frame(st), "job-b", "provider-a", FROM, TO, _now(), "TTF"
    ).select(
        "arrival_seq", "event_id", "instrument", "event_timestamp", "is_replay", "replay_source"
    )


_DLQ_REPLAY = f"""
SELECT seq AS arrival_seq, md5('job-d|' || original_event_id || '|' || seq) AS event_id, provider,
  instrument, 'dlq' AS replay_source
FROM w_dlq WHERE dlq_timestamp {_BETWEEN}
"""


@query("replay_dlq", _DLQ_REPLAY)
def replay_dlq(st: Stages):
    return replay.replay_dlq(
        st.kept.dead_letters, "job-d", F.lit(FROM), F.lit(TO), _now()
    ).select("arrival_seq", "event_id", "provider", "instrument", "replay_source")


@query("replay_vendor", """
SELECT seq AS arrival_seq, instrument, traded_at AS event_timestamp FROM (
  SELECT seq, 'CL' AS instrument, traded_at FROM w_bar
  WHERE symbol = 'CL' AND l_linenumber <> 6
    AND epoch_us(traded_at) * 1000 + seq % 1000
      BETWEEN epoch_us(TIMESTAMP '1999-01-01') * 1000 AND epoch_us(TIMESTAMP '1999-03-31') * 1000)
""")
def replay_vendor(st: Stages):
    start = datetime(1999, 1, 1, tzinfo=timezone.utc)
    end = datetime(1999, 3, 31, tzinfo=timezone.utc)
    return replay.replay_vendor(
        trades(st), "job-v", start, end, _now(), "vendor-x", "CL"
    ).select("arrival_seq", "instrument", "event_timestamp")


@query("replay_request", """
SELECT job_id, CASE WHEN day(start_time) % 7 = 0 THEN 'end_time must be after start_time'
  WHEN source <> 'dlq' AND day(start_time) % 6 = 0 THEN 'provider is required' END AS error
FROM w_job
""")
def replay_request(st: Stages):
    number = F.dayofmonth("start_time")
    asked = st.replay_jobs.withColumn(
        "end_time", F.when(number % 7 == 0, F.col("start_time")).otherwise(F.col("end_time"))
    ).withColumn("provider", F.when(number % 6 == 0, "").otherwise(F.col("provider")))
    return replay.request_errors(asked).select("job_id", "error")


@query("replay_merge", f"""
SELECT is_replay, count(*) AS events FROM (
  SELECT false AS is_replay FROM w_raw
  UNION ALL SELECT true FROM (SELECT 1 FROM w_dlq WHERE dlq_timestamp {_BETWEEN}))
GROUP BY is_replay
""")
def replay_merge(st: Stages):
    replayed = replay.replay_dlq(st.kept.dead_letters, "job-d", F.lit(FROM), F.lit(TO), _now())
    return replay.merge_replay(st.raw, replayed).groupBy("is_replay").agg(
        F.count(F.lit(1)).alias("events")
    )


@query("replay_throttle", """
SELECT seq AS arrival_seq, TIMESTAMP '2024-02-01 00:00:00' + to_seconds((row_number() OVER (
  ORDER BY received_at, seq) - 1) // 10) AS release_at
FROM w_raw WHERE provider = 'provider-a'
""")
def replay_throttle(st: Stages):
    replayed = st.raw.where("provider = 'provider-a'")
    return replay.paced(replayed, _now(), 10).select("arrival_seq", "release_at")


@query("replay_jobs", """
SELECT job_id, source, status, requested_at FROM w_job ORDER BY requested_at DESC, job_id LIMIT 50
""")
def replay_jobs(st: Stages):
    jobs = st.replay_jobs
    pending = jobs.where("status = 'pending'")
    return replay.list_jobs(pending, jobs).select("job_id", "source", "status", "requested_at")


@query("replay_audit", """
SELECT j.job_id, j.events_to_replay, j.events_replayed, count(r.seq) AS emitted,
  j.events_replayed = j.events_to_replay AS complete
FROM w_job j LEFT JOIN w_raw r
  ON r.provider = j.provider AND date_trunc('day', r.received_at) = j.start_time
GROUP BY ALL
""")
def replay_audit(st: Stages):
    emitted = st.raw.where(F.col("provider") != "").select(
        F.concat_ws("-", F.lit("job"), "provider", F.date_format("received_at", "yyyyMMdd")).alias(
            "job_id"
        )
    )
    return replay.audit(st.replay_jobs, emitted)


@query("bronze_gap_check", """
SELECT p.provider, h.g AS hour
FROM (SELECT DISTINCT provider FROM w_raw WHERE provider <> '') p,
  (SELECT unnest(generate_series(min(date_trunc('hour', received_at)), max(date_trunc('hour', received_at)),
     INTERVAL 1 HOUR)) AS g FROM w_raw WHERE provider <> '') h
WHERE NOT EXISTS (SELECT 1 FROM w_raw r WHERE r.provider = p.provider
                  AND date_trunc('hour', r.received_at) = h.g)
""")
def bronze_gap_check(st: Stages):
    # The nameless provider has no folder of its own name; its hours are not asked for.
    named = bronze.manifest(st.spark, bronze_root(st)).where("provider <> '' AND provider <> '__HIVE_DEFAULT_PARTITION__'")
    hours = replay.partition_hours(named)
    # From the first to the last hour that holds anything.
    first, last = (hours.agg(end("hour")).scalar() for end in (F.min, F.max))
    return replay.bronze_gaps(hours, hours, first, last)
