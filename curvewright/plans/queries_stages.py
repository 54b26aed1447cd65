"""Validation, normalisation and snapshot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvewright.functions.clock import seconds_between
from curvewright.functions.tenors import delivery_period
from curvewright.operators import gold, normalise, quality, validate
from curvewright.plans.registry import query, r6
from curvewright.plans.stages import DAY, Stages

# -- validation --------------------------------------------------------------


@query("val_required", """
SELECT seq AS arrival_seq, structure_reason AS reason FROM w_structure
WHERE structure_category = 'missing_required_field'
""")
def val_required(st: Stages):
    return (
        validate.apply_rules(st.raw)
        .where("structure_category = 'missing_required_field'")
        .select("arrival_seq", F.col("structure_reason").alias("reason"))
    )


@query("val_types", """
SELECT seq AS arrival_seq, structure_reason AS reason FROM w_structure
WHERE structure_category = 'schema_violation'
""")
def val_types(st: Stages):
    return (
        validate.apply_rules(st.raw)
        .where("structure_category = 'schema_violation'")
        .select("arrival_seq", F.col("structure_reason").alias("reason"))
    )


@query("val_dedup", """
SELECT provider, event_id, seq AS arrival_seq FROM w_outcome WHERE outcome = 'duplicate'
""")
def val_dedup(st: Stages):
    return st.outcomes.where("outcome = 'duplicate'").select("provider", "event_id", "arrival_seq")


@query("val_dedup_copies", """
, f AS (
  SELECT event_id, structure_category, received_at + to_seconds(CASE WHEN seq % 14 = 0 THEN 3000 * c ELSE 0 END)
    AS received_at, seq * 16 + CASE WHEN seq % 14 = 0 THEN c ELSE 0 END AS pos
  FROM w_structure, (SELECT unnest(range(10)) AS c)
  WHERE c < CASE seq % 14 WHEN 0 THEN 10 WHEN 2 THEN 3 ELSE 1 END),
g AS (SELECT DISTINCT event_id, epoch_us(received_at) // 1000 AS ms, pos, received_at
      FROM f WHERE structure_category IS NULL),
a AS (
  SELECT event_id, ms, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY received_at, pos) AS rn FROM g) WHERE rn = 1
  UNION ALL
  SELECT event_id, ms, pos FROM (
    SELECT g.event_id, g.ms, g.pos,
           row_number() OVER (PARTITION BY g.event_id ORDER BY g.received_at, g.pos) AS rn
    FROM a JOIN g ON g.event_id = a.event_id AND g.ms >= a.ms + 3600000) WHERE rn = 1)
SELECT f.event_id, f.pos AS arrival_seq, count(*) AS copies,
  CAST(CASE WHEN any_value(structure_category) IS NOT NULL THEN 0
       WHEN any_value(a.pos) IS NOT NULL THEN count(*) - 1 ELSE count(*) END AS BIGINT) AS repeated
FROM f LEFT JOIN a ON a.event_id = f.event_id AND a.pos = f.pos
GROUP BY f.event_id, f.pos
""")
def val_dedup_copies(st: Stages):
    """The whole feed; some events come as chains of copies longer than the time to live, some as equal rows."""
    number = F.col("arrival_seq")
    chain = number % 14 == 0
    copies = F.when(chain, F.sequence(F.lit(0), F.lit(9))).when(number % 14 == 2, F.array_repeat(F.lit(0), 3))
    copied = st.raw.withColumn("c", F.explode(F.coalesce(copies, F.array(F.lit(0))))).withColumns(
        {
            "received_at": F.timestamp_micros(F.unix_micros("received_at") + F.col("c").cast("bigint") * 3_000_000_000),
            "arrival_seq": number * 16 + F.col("c"),
        }
    ).drop("c")
    return (
        validate.validate(copied)
        .groupBy("event_id", "arrival_seq")
        .agg(F.count(F.lit(1)).alias("copies"), F.count_if(F.col("outcome") == "duplicate").alias("repeated"))
    )


@query("val_time_bounds", """
SELECT seq AS arrival_seq, category, reason FROM w_outcome
WHERE category IN ('stale', 'out_of_order')
""")
def val_time_bounds(st: Stages):
    return st.outcomes.where("category IN ('stale', 'out_of_order')").select(
        "arrival_seq", "category", "reason"
    )


@query("val_price_bounds", """
SELECT seq AS arrival_seq, category, reason FROM w_outcome WHERE category = 'malformed'
""")
def val_price_bounds(st: Stages):
    return st.outcomes.where("category = 'malformed'").select("arrival_seq", "category", "reason")


@query("val_route", """
SELECT seq AS arrival_seq, outcome, coalesce(category, 'none') AS category FROM w_outcome
""")
def val_route(st: Stages):
    return st.outcomes.select(
        "arrival_seq", "outcome", F.coalesce("category", F.lit("none")).alias("category")
    )


@query("val_project", """
SELECT validated_id AS event_id, event_id AS original_event_id, provider, instrument,
  received_at, event_timestamp, received_at AS validated_at, false AS corrected_timestamp,
  array_to_string(faults, ',') AS faults, false AS is_replay, trace_id
FROM w_passed
""")
def val_project(st: Stages):
    return st.validated.select(
        "event_id",
        "original_event_id",
        "provider",
        "instrument",
        "received_at",
        "event_timestamp",
        "validated_at",
        "corrected_timestamp",
        F.array_join("injected_faults", ",").alias("faults"),
        "is_replay",
        "trace_id",
    )


@query("dlq_build", """
SELECT dlq_event_id, original_event_id, provider, instrument, failure_reason, failure_category,
  dlq_timestamp, CAST(0 AS BIGINT) AS retry_count, trace_id,
  original_event_id AS payload_event_id, trace_id AS payload_trace_id
FROM w_dlq
""")
def dlq_build(st: Stages):
    return st.dead_letters.select(
        "dlq_event_id",
        "original_event_id",
        "provider",
        "instrument",
        "failure_reason",
        "failure_category",
        "dlq_timestamp",
        "retry_count",
        "trace_id",
        F.get_json_object("raw_payload", "$.event_id").alias("payload_event_id"),
        F.get_json_object("raw_payload", "$.trace_id").alias("payload_trace_id"),
    )


@query("score_event", """
SELECT seq AS arrival_seq, provider, round(CAST(score AS DOUBLE), 6) AS quality_score FROM w_passed
""")
def score_event(st: Stages):
    return validate.scored_events(st.outcomes).select("arrival_seq", "provider", r6("quality_score"))


@query("score_rolling", """
SELECT provider, events,
  round(CAST(st.s AS DOUBLE) + 1e-9, 6) AS rolling_sum,
  round(CAST(st.c AS DOUBLE), 6) AS rolling_count,
  round(CAST(st.s / st.c AS DOUBLE) + 1e-9, 6) AS rolling_average
FROM (
  SELECT provider, count(*) AS events,
    list_reduce(
      [{'s': 0.0::DOUBLE, 'c': 0.0::DOUBLE}]
      || list({'s': score::DOUBLE, 'c': 1.0::DOUBLE} ORDER BY received_at, seq),
      lambda a, x: {
        's': (a.s + x.s) / CASE WHEN a.c + 1 >= 100 THEN 2 ELSE 1 END,
        'c': (a.c + 1) / CASE WHEN a.c + 1 >= 100 THEN 2 ELSE 1 END}) AS st
  FROM w_passed GROUP BY provider)
""")
def score_rolling(st: Stages):
    rolled = validate.rolling_scores(validate.scored_events(st.kept.outcomes))
    # Halved sums often end in an exact 5; the nudge rounds them alike everywhere.
    return validate.rolling_state(rolled).select(
        "provider",
        "events",
        F.round(F.col("rolling_sum") + 1e-9, 6).alias("rolling_sum"),
        r6("rolling_count"),
        F.round(F.col("rolling_average") + 1e-9, 6).alias("rolling_average"),
    )


@query("obs_latency", """
SELECT provider, le, count(*) FILTER (abs(latency_ms) / 1000 <= le) AS events
FROM w_passed CROSS JOIN (VALUES (0.001), (0.005), (0.01), (0.05), (0.1), (0.5), (1.0), (5.0),
  (30.0), ('inf'::DOUBLE)) b(le)
GROUP BY provider, le
""")
def obs_latency(st: Stages):
    return validate.latency_histogram(st.outcomes)


@query("outcome_counts", """
SELECT provider, outcome, coalesce(category, 'none') AS category, count(*) AS events
FROM w_outcome GROUP BY ALL
""")
def outcome_counts(st: Stages):
    return validate.outcome_counts(st.outcomes)


# -- normalisation -----------------------------------------------------------


@query("nrm_instrument", """
SELECT p.validated_id AS event_id, a.canonical, a.canonical IS NOT NULL AS is_known
FROM w_passed p LEFT JOIN w_alias a ON a.alias = upper(trim(p.instrument))
""")
def nrm_instrument(st: Stages):
    return st.validated.select(
        "event_id",
        normalise.canonical_instrument(F.col("instrument")).alias("canonical"),
        normalise.is_known_instrument(F.col("instrument")).alias("is_known"),
    )


@query("nrm_units", """
SELECT p.validated_id AS event_id, u.currency, u.unit
FROM w_passed p JOIN w_alias a ON a.alias = upper(trim(p.instrument))
JOIN w_unit u ON u.canonical = a.canonical
""")
def nrm_units(st: Stages):
    canonical = normalise.canonical_instrument(F.col("instrument"))
    return st.validated.where(canonical.isNotNull()).select(
        "event_id",
        normalise.instrument_currency(canonical).alias("currency"),
        normalise.instrument_unit(canonical).alias("unit"),
    )


@query("nrm_price", """
SELECT validated_id AS event_id, CAST(price AS DOUBLE) AS price FROM w_interpreted
WHERE canonical IS NOT NULL AND price IS NOT NULL
""")
def nrm_price(st: Stages):
    return st.interpreted.where("canonical IS NOT NULL AND price IS NOT NULL").select(
        "event_id", "price"
    )


@query("nrm_tenor", """
SELECT validated_id AS event_id, coalesce(tenor, 'unmatched') AS tenor FROM w_interpreted
""")
def nrm_tenor(st: Stages):
    return st.interpreted.select(
        "event_id", F.coalesce("tenor", F.lit("unmatched")).alias("tenor")
    )


@query("nrm_tenor_relative", """
SELECT raw_tenor, tenor, count(*) AS events FROM w_interpreted
WHERE raw_tenor IN ('M+1', 'M+7', 'Q+2') GROUP BY ALL
""")
def nrm_tenor_relative(st: Stages):
    raw = F.get_json_object("payload", "$.tenor")
    return (
        st.interpreted.withColumn("raw_tenor", raw)
        .where(F.col("raw_tenor").isin("M+1", "M+7", "Q+2"))
        .groupBy("raw_tenor", "tenor")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query("nrm_tenor_fallback", """
SELECT CASE WHEN raw_tenor IS NULL THEN 'json_null' ELSE 'empty' END AS tenor_source,
  coalesce(tenor, 'unmatched') AS tenor, instrument, count(*) AS events
FROM w_interpreted WHERE raw_tenor IS NULL OR raw_tenor = '' GROUP BY ALL
""")
def nrm_tenor_fallback(st: Stages):
    text = F.get_json_object("payload", "$.tenor")
    return (
        st.interpreted.withColumn("_text", text)
        .where("_text IS NULL OR _text = ''")
        .groupBy(
            F.when(F.col("_text").isNull(), "json_null").otherwise("empty").alias("tenor_source"),
            F.coalesce("tenor", F.lit("unmatched")).alias("tenor"),
            "instrument",
        )
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query("nrm_period", """
SELECT tenor, CASE WHEN tenor = 'spot' THEN 'spot' WHEN tenor LIKE '%-CAL' THEN 'annual'
  WHEN tenor LIKE '%-SUM' OR tenor LIKE '%-WIN' THEN 'seasonal'
  WHEN tenor LIKE '%-Q_' THEN 'quarterly' ELSE 'monthly' END AS delivery_period,
  count(*) AS events
FROM w_interpreted WHERE tenor IS NOT NULL GROUP BY ALL
""")
def nrm_period(st: Stages):
    return (
        st.interpreted.where("tenor IS NOT NULL")
        .groupBy("tenor")
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("delivery_period", delivery_period(F.col("tenor")))
    )


@query("nrm_curve_name", """
SELECT curve_name, instrument, delivery_period, count(*) AS events FROM w_curve GROUP BY ALL
""")
def nrm_curve_name(st: Stages):
    return st.curves_unversioned.groupBy("curve_name", "instrument", "delivery_period").agg(
        F.count(F.lit(1)).alias("events")
    )


@query("nrm_score", """
SELECT event_id, CAST(quality_score AS DOUBLE) AS quality_score FROM w_curve
""")
def nrm_score(st: Stages):
    return st.curves_unversioned.select("event_id", "quality_score")


@query("nrm_version", """
SELECT curve_name, event_id, CAST(version AS BIGINT) AS version FROM w_curve
""")
def nrm_version(st: Stages):
    return st.curves.select("curve_name", "event_id", "version")


@query("nrm_reject_stats", """
SELECT provider, reject_reason, count(*) AS events FROM w_interpreted
WHERE reject_reason IS NOT NULL GROUP BY ALL
""")
def nrm_reject_stats(st: Stages):
    return normalise.reject_counts(st.interpreted)


@query("nrm_event", """
SELECT event_id, source_event_id, curve_name, instrument, tenor, delivery_period, price, currency,
  unit, provider, CAST(version AS BIGINT) AS version, event_timestamp,
  received_at AS ingestion_timestamp, CAST(quality_score AS DOUBLE) AS quality_score, trace_id
FROM w_curve
""")
def nrm_event(st: Stages):
    return st.curves.select(
        "event_id",
        "source_event_id",
        "curve_name",
        "instrument",
        "tenor",
        "delivery_period",
        "price",
        "currency",
        "unit",
        "provider",
        "version",
        "event_timestamp",
        "ingestion_timestamp",
        "quality_score",
        "trace_id",
    )


# -- snapshots ---------------------------------------------------------------


@query("gold_window", """
SELECT curve_name, to_timestamp(floor(epoch(event_timestamp) / 300) * 300)::TIMESTAMP
    AS window_start, count(*) AS events
FROM w_curve GROUP BY ALL
""")
def gold_window(st: Stages):
    from curvewright.functions.clock import floor_to

    start = floor_to(F.col("event_timestamp"), gold.WINDOW_SECONDS).alias("window_start")
    return st.curves_unversioned.groupBy("curve_name", start).agg(
        F.count(F.lit(1)).alias("events")
    )


@query("gold_lww", """
SELECT curve_name, window_start, tenor, price, CAST(quality_score AS DOUBLE) AS quality_score,
  last_updated, n_events AS events FROM w_tenor_price
""")
def gold_lww(st: Stages):
    unversioned = st.curves_unversioned.withColumn("version", F.lit(0))
    return gold.tenor_prices(unversioned, DAY).select(
        "curve_name", "window_start", "tenor", "price", "quality_score", "last_updated", "events"
    )


@query("gold_version", """
SELECT curve_name, window_start, CAST(version AS BIGINT) AS version, provider, instrument
FROM w_window
""")
def gold_version(st: Stages):
    return st.windows.select("curve_name", "window_start", "version", "provider", "instrument")


@query("gold_tenor_map", """
SELECT curve_name, window_start AS as_of, tenor, printf('%.8f', price) AS price,
  CAST(quality_score AS DOUBLE) AS quality_score,
  strftime(last_updated, '%Y-%m-%dT%H:%M:%S.%fZ') AS last_updated
FROM w_tenor_price
""")
def gold_tenor_map(st: Stages):
    entry = "map<string, struct<price: string, quality_score: double, last_updated: string>>"
    mapped = st.windows.select(
        "curve_name",
        F.col("window_start").alias("as_of"),
        F.from_json(gold.tenor_json(), entry).alias("tenors"),
    )
    return mapped.select("curve_name", "as_of", F.explode("tenors").alias("tenor", "p")).select(
        "curve_name", "as_of", "tenor", "p.price", "p.quality_score", "p.last_updated"
    )


@query("gold_expected", """
SELECT curve_name, window_start, CAST(num_tenors AS BIGINT) AS num_tenors,
  CAST(expected AS BIGINT) AS expected_tenors FROM w_window
""")
def gold_expected(st: Stages):
    return st.snapshots.select("curve_name", "window_start", "num_tenors", "expected_tenors")


@query("gold_completeness", """
SELECT curve_name, window_start, round(completeness, 6) AS completeness FROM w_snapshot
""")
def gold_completeness(st: Stages):
    return st.snapshots.select("curve_name", "window_start", r6("completeness"))


@query("gold_authoritative", """
SELECT curve_name, window_start, CAST(min_quality AS DOUBLE) AS min_quality, is_authoritative
FROM w_snapshot
""")
def gold_authoritative(st: Stages):
    return st.snapshots.select("curve_name", "window_start", "min_quality", "is_authoritative")


@query("gold_emit", """
SELECT curve_name, window_start FROM w_window, w_clock
WHERE window_start + INTERVAL 3 DAY <= as_of
""")
def gold_emit(st: Stages):
    return gold.closed_windows(st.windows, st.as_of, DAY).select("curve_name", "window_start")


@query("gold_gate", """
SELECT curve_name, window_start, round(completeness, 6) AS completeness FROM w_snapshot
WHERE completeness >= 0.80
""")
def gold_gate(st: Stages):
    return gold.gate(st.snapshots).select("curve_name", "window_start", r6("completeness"))


@query("gold_select", """
SELECT count(*) AS assembled, count(*) FILTER (is_authoritative) AS loaded,
  count(*) FILTER (NOT is_authoritative) AS skipped
FROM w_snapshot WHERE completeness >= 0.80
""")
def gold_select(st: Stages):
    return gold.flush_counts(gold.gate(st.snapshots))


@query("gold_pending", """
SELECT count(*) AS pending_windows FROM w_window, w_clock
WHERE window_start + INTERVAL 3 DAY > as_of
""")
def gold_pending(st: Stages):
    return gold.pending_count(st.windows, st.as_of, DAY)


@query("gold_shape", """
SELECT curve_name, as_of, round(front_price, 6) AS front_price,
  round(curve_slope, 6) AS curve_slope, CAST(num_tenors AS BIGINT) AS num_tenors,
  stale_tenors, outlier_tenors
FROM w_gold
""")
def gold_shape(st: Stages):
    return st.gold.select(
        "curve_name",
        "as_of",
        r6("front_price"),
        r6("curve_slope"),
        "num_tenors",
        "stale_tenors",
        "outlier_tenors",
    )


@query("quality_history", """
SELECT o.provider, o.measurement_window, o.window_start, o.window_end, o.events_count,
  o.dlq_count, o.warning_count, o.quality_score, c.completeness_pct, o.avg_latency_ms,
  o.p99_latency_ms
FROM (
  SELECT provider, g AS measurement_window,
    date_trunc(CASE g WHEN 'HOURLY' THEN 'hour' WHEN 'DAILY' THEN 'day' ELSE 'week' END,
               x.received_at) AS window_start,
    date_trunc(CASE g WHEN 'HOURLY' THEN 'hour' WHEN 'DAILY' THEN 'day' ELSE 'week' END,
               x.received_at)
      + CASE g WHEN 'HOURLY' THEN INTERVAL 1 HOUR WHEN 'DAILY' THEN INTERVAL 1 DAY
               ELSE INTERVAL 7 DAY END AS window_end,
    count(*) AS events_count,
    count(*) FILTER (outcome = 'failed') AS dlq_count,
    count(*) FILTER (outcome = 'passed' AND len(faults) > 0) AS warning_count,
    round(sum(CAST(round(score * 100) AS BIGINT)) / (count(score) * 100), 4) AS quality_score,
    round(avg(CASE WHEN outcome = 'passed' THEN floor(latency_ms) END), 2) AS avg_latency_ms,
    round(quantile_cont(CASE WHEN outcome = 'passed' THEN floor(latency_ms) END, 0.99), 2)
      AS p99_latency_ms
  FROM (SELECT o.*, p.score FROM w_outcome o LEFT JOIN w_passed p USING (seq)
        WHERE o.outcome <> 'duplicate') x,
       (VALUES ('HOURLY'), ('DAILY'), ('WEEKLY')) s(g)
  GROUP BY ALL) o
LEFT JOIN (
  SELECT provider, g AS measurement_window,
    date_trunc(CASE g WHEN 'HOURLY' THEN 'hour' WHEN 'DAILY' THEN 'day' ELSE 'week' END, as_of)
      AS window_start, round(avg(completeness_pct), 2) AS completeness_pct
  FROM w_gold, (VALUES ('HOURLY'), ('DAILY'), ('WEEKLY')) s(g) GROUP BY ALL) c
USING (provider, measurement_window, window_start)
""")
def quality_history(st: Stages):
    return quality.quality_history(st.kept.outcomes, st.kept.gold).select(
        "provider",
        "measurement_window",
        "window_start",
        "window_end",
        "events_count",
        "dlq_count",
        "warning_count",
        "quality_score",
        "completeness_pct",
        "avg_latency_ms",
        "p99_latency_ms",
    )
