"""Monitoring and alert queries.

The derived feed carries an event every few minutes, so windows and limits are
wider here than the operators' defaults.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from curvewright.operators import alerts, monitor, serving, validate
from curvewright.operators.quality import latency_ms
from curvewright.plans.oracle_ctes import define
from curvewright.plans.queries_sources import bronze_root
from curvewright.plans.registry import query, r6
from curvewright.plans.stages import DAY, Stages
from curvewright.sources import bronze

HOUR = 3600

define("w_load_log", """
SELECT layer, provider, loaded_at, n AS n_rows, n * 137 * factor + slot % 11 * 400 AS duration_ms,
  n_bytes, CASE WHEN (slot + factor) % 23 = 0 THEN 'failed' ELSE 'success' END AS outcome
FROM (
  SELECT provider, date_trunc('hour', received_at) AS loaded_at, count(*) AS n,
    epoch_us(date_trunc('hour', received_at)) // 3600000000 AS slot,
    sum(CASE price_kind WHEN 'text' THEN 24 WHEN 'null' THEN 13 WHEN 'absent' THEN 0
        ELSE 9 + length(CAST(price AS VARCHAR)) END
        + 1 + 8 + coalesce(length(raw_tenor) + 2, 4) + 10 + length(CAST(k AS VARCHAR)) + 56)
      AS n_bytes
  FROM w_raw GROUP BY 1, 2), (VALUES ('bronze', 1), ('silver', 2), ('gold', 3)) l(layer, factor)
""")

define("w_job", """
SELECT 'job-' || provider || '-' || strftime(d, '%Y%m%d') AS job_id,
  (['bronze_s3', 'dlq', 'databento_historical'])[day(d) % 3 + 1] AS source, provider,
  d AS start_time, d + INTERVAL 1 DAY AS end_time, d + INTERVAL 30 HOUR AS requested_at,
  (['completed', 'failed', 'running', 'pending'])[day(d) % 4 + 1] AS status,
  n AS events_to_replay, n - CASE WHEN day(d) % 5 = 0 THEN 3 ELSE 0 END AS events_replayed,
  n * 20 + day(d) * 1000 AS duration_ms
FROM (SELECT provider, date_trunc('day', received_at) AS d, count(*) AS n FROM w_raw
      WHERE provider <> '' GROUP BY 1, 2)
""")

define("w_hour_grid", """
SELECT DISTINCT provider, t.g AS eval_time
FROM (SELECT DISTINCT provider FROM w_raw), (
  SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-02', INTERVAL 1 HOUR)) AS g) t
""")


def _evaluations(hours: int) -> str:
    return f"""
SELECT g.provider, g.eval_time, count(d.seq) AS letters, count(d.seq) * 60.0 / {hours * 3600} AS per_minute
FROM w_hour_grid g JOIN w_dlq d ON d.provider = g.provider
  AND d.dlq_timestamp < g.eval_time AND d.dlq_timestamp >= g.eval_time - INTERVAL {hours} HOUR
GROUP BY 1, 2
"""


define("w_eval_spike", _evaluations(6))
define("w_eval_critical", _evaluations(12))
define("w_eval_malformed", """
SELECT g.provider, g.eval_time, count(*) FILTER (d.category = 'malformed') AS malformed,
  count(*) AS ingested,
  count(*) FILTER (d.category = 'malformed') / (count(*) + 1e-9::DOUBLE) AS ratio
FROM w_hour_grid g JOIN w_outcome d ON d.provider = g.provider
  AND d.received_at < g.eval_time AND d.received_at >= g.eval_time - INTERVAL 6 HOUR
GROUP BY 1, 2
""")


def _held(source: str, condition: str, hold_hours: int) -> str:
    return f"""
SELECT provider, min(eval_time) AS pending_from, max(eval_time) AS ends_at, count(*) AS evaluations,
  min(eval_time) + INTERVAL {hold_hours} HOUR AS starts_at
FROM (SELECT *, eval_time - to_hours(CAST(row_number() OVER (PARTITION BY provider ORDER BY eval_time)
        AS INTEGER)) AS island
      FROM {source} WHERE {condition})
GROUP BY provider, island HAVING max(eval_time) - min(eval_time) >= INTERVAL {hold_hours} HOUR
"""


define("w_held_spike", _held("w_eval_spike", "per_minute > 0.004", 1))
define("w_held_critical", _held("w_eval_critical", "per_minute > 0.006", 0))
define("w_held_malformed", _held("w_eval_malformed", "ratio > 0.05", 1))
define("w_gap", """
SELECT provider, received_at AS last_event_at, resumed_at,
  (epoch_us(coalesce(resumed_at, as_of + INTERVAL 6 HOUR)) - epoch_us(received_at)) / 1e6 AS gap_seconds,
  as_of + INTERVAL 6 HOUR AS looked_at
FROM w_clock, (SELECT provider, received_at, lead(received_at) OVER (PARTITION BY provider ORDER BY received_at)
        AS resumed_at FROM (SELECT DISTINCT provider, received_at FROM w_raw))
""")
define("w_alert", """
SELECT 'DLQSpike' AS alertname, 'validation' AS component, 'warning' AS severity, provider,
  starts_at, ends_at FROM w_held_spike
UNION ALL SELECT 'DLQCritical', 'validation', 'critical', provider, starts_at, ends_at
FROM w_held_critical
UNION ALL SELECT 'HighMalformedRate', 'feed', 'warning', provider, starts_at, ends_at
FROM w_held_malformed
UNION ALL SELECT 'ProviderOutage', 'feed', 'critical', provider,
  last_event_at + INTERVAL 15000 SECOND, coalesce(resumed_at, looked_at) FROM w_gap WHERE gap_seconds > 15000
""")


@query("mon_ingest_rate", """
SELECT date_trunc('minute', received_at) AS window_start, provider, count(*) AS events,
  round(count(*) / 60, 6) AS per_second FROM w_raw GROUP BY 1, 2
""")
def mon_ingest_rate(st: Stages):
    return monitor.rate(st.raw, "received_at", ["provider"]).withColumn(
        "per_second", F.round("per_second", 6)
    )


@query("mon_dlq_rate", """
SELECT date_trunc('minute', dlq_timestamp) AS window_start, failure_category, count(*) AS events,
  round(count(*) / 60, 6) AS per_second FROM w_dlq GROUP BY 1, 2
""")
def mon_dlq_rate(st: Stages):
    return monitor.rate(st.dead_letters, "dlq_timestamp", ["failure_category"]).withColumn(
        "per_second", F.round("per_second", 6)
    )


@query("mon_pass_rate", """
SELECT to_timestamp(epoch_us(received_at) // 120000000 * 120)::TIMESTAMP AS window_start, provider,
  round(100.0 * count(*) FILTER (outcome = 'passed') / (count(*) + 1e-9::DOUBLE), 6)
    AS pass_rate_pct
FROM w_outcome GROUP BY 1, 2
""")
def mon_pass_rate(st: Stages):
    return monitor.pass_rate(st.outcomes).withColumn(
        "pass_rate_pct", F.round("pass_rate_pct", 6)
    )


@query("mon_lag", """
SELECT 'market.events.raw' AS topic, seq % 6 AS topic_partition,
  greatest(0, max(seq) + 1 - coalesce(max(CASE WHEN seq % 6 < 5
    AND received_at <= (SELECT as_of FROM w_clock) - INTERVAL 1 DAY THEN seq + 1 END), 0)) AS lag,
  CASE WHEN max(seq) + 1 - coalesce(max(CASE WHEN seq % 6 < 5
    AND received_at <= (SELECT as_of FROM w_clock) - INTERVAL 1 DAY THEN seq + 1 END), 0) > 50000
    THEN 'critical'
    WHEN max(seq) + 1 - coalesce(max(CASE WHEN seq % 6 < 5
    AND received_at <= (SELECT as_of FROM w_clock) - INTERVAL 1 DAY THEN seq + 1 END), 0) > 10000
    THEN 'warning' ELSE 'ok' END AS severity
FROM w_raw GROUP BY seq % 6
""")
def mon_lag(st: Stages):
    from curvewright.functions.clock import after

    placed = st.raw.select(
        F.lit("market.events.raw").alias("topic"),
        (F.col("arrival_seq") % 6).alias("topic_partition"),
        (F.col("arrival_seq") + 1).alias("next_offset"),
        "received_at",
    )
    keys = ["topic", "topic_partition"]
    head = placed.groupBy(*keys).agg(F.max("next_offset").alias("head_offset"))
    committed = (
        placed.where((F.col("topic_partition") < 5) & (F.col("received_at") <= after(st.as_of, -DAY)))
        .groupBy(*keys)
        .agg(F.max("next_offset").alias("committed_offset"))
    )
    return monitor.lag(head, committed)


@query("mon_quality_avg", """
SELECT to_timestamp(epoch_us(received_at) // 300000000 * 300)::TIMESTAMP AS window_start, provider,
  round(sum(CAST(round(score * 100) AS BIGINT)) / (count(*) * 100), 6) AS avg_quality
FROM w_passed GROUP BY 1, 2
""")
def mon_quality_avg(st: Stages):
    return monitor.mean_quality(st.outcomes.where("outcome = 'passed'")).withColumn(
        "avg_quality", F.round("avg_quality", 6)
    )


@query("mon_latency_p95", """
SELECT e.provider, e.p95_ms, b.bucketed_seconds FROM (
  SELECT provider, round(quantile_cont(floor(latency_ms), 0.95), 6) AS p95_ms
  FROM w_passed GROUP BY provider) e
JOIN (
  SELECT provider, round(CASE WHEN le = 'inf'::DOUBLE THEN low
      ELSE low + (le - low) * (0.95 * total - under) / (n - under) END, 6) AS bucketed_seconds
  FROM (
    SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(n) OVER w, 0) AS under,
      max(n) OVER (PARTITION BY provider) AS total
    FROM (SELECT provider, le, count(*) FILTER (abs(latency_ms) / 1000 <= le) AS n
          FROM w_passed CROSS JOIN (VALUES (0.001::DOUBLE), (0.005), (0.01), (0.05), (0.1), (0.5),
            (1.0), (5.0), (30.0), ('inf'::DOUBLE)) b(le) GROUP BY provider, le)
    WINDOW w AS (PARTITION BY provider ORDER BY le))
  WHERE n >= 0.95 * total AND under < 0.95 * total) b USING (provider)
""")
def mon_latency_p95(st: Stages):
    timed = st.kept.outcomes.where("outcome = 'passed'").withColumn("latency_ms", latency_ms())
    exact = monitor.exact_p95(timed, ["provider"], "latency_ms").withColumnRenamed("p95", "p95_ms")
    bucketed = monitor.bucket_quantile(
        validate.latency_histogram(st.kept.outcomes), ["provider"], 0.95
    ).withColumnRenamed("quantile", "bucketed_seconds")
    return exact.join(bucketed, "provider").select(
        "provider", r6("p95_ms"), r6("bucketed_seconds")
    )


@query("mon_bronze_rate", """
SELECT to_timestamp(epoch_us(received_at) // 21600000000 * 21600)::TIMESTAMP AS window_start,
  count(DISTINCT provider || strftime(received_at, '%Y-%m-%d %H')) AS files,
  round(count(DISTINCT provider || strftime(received_at, '%Y-%m-%d %H')) / 21600, 6) AS per_second
FROM w_raw GROUP BY 1
""")
def mon_bronze_rate(st: Stages):
    # Folders that a write left files in, as the manifest tells.
    written = bronze.manifest(st.spark, bronze_root(st)).select(
        F.to_timestamp(F.concat_ws(" ", "dt", "hh"), "yyyy-MM-dd HH").alias("hour"),
        F.regexp_extract("path", "^(.*)/", 1).alias("folder"),
    )
    return monitor.file_rate(written, "hour", "folder", 6 * HOUR).withColumn(
        "per_second", F.round("per_second", 6)
    )


@query("mon_replay_outcomes", """
SELECT to_timestamp(epoch_us(requested_at) // 300000000 * 300)::TIMESTAMP AS window_start, status,
  count(*) AS events, round(count(*) / 300, 6) AS per_second FROM w_job GROUP BY 1, 2
""")
def mon_replay_outcomes(st: Stages):
    return monitor.rate(st.replay_jobs, "requested_at", ["status"], 300).withColumn(
        "per_second", F.round("per_second", 6)
    )


@query("mon_fault_mix", """
SELECT to_timestamp(epoch_us(received_at) // 300000000 * 300)::TIMESTAMP AS window_start, provider,
  fault, count(*) AS events, round(count(*) / 300, 6) AS per_second
FROM (SELECT received_at, provider, unnest(faults) AS fault FROM w_raw) GROUP BY 1, 2, 3
""")
def mon_fault_mix(st: Stages):
    return monitor.fault_mix(st.raw).withColumn("per_second", F.round("per_second", 6))


@query("mon_dlq_depth", """
SELECT provider, minute, CAST(sum(c) OVER (PARTITION BY provider ORDER BY minute) AS BIGINT) AS depth
FROM (
  SELECT provider, minute, sum(c) AS c FROM (
    SELECT provider, date_trunc('minute', dlq_timestamp) AS minute, 1 AS c FROM w_dlq
    UNION ALL SELECT provider, date_trunc('minute', dlq_timestamp + INTERVAL 1 HOUR), -1
    FROM w_dlq WHERE retry_status = 'RESOLVED') GROUP BY 1, 2)
""")
def mon_dlq_depth(st: Stages):
    return monitor.dlq_depth(st.dlq_table).select("provider", "minute", "depth")


@query("mon_bronze_stats", """
SELECT provider, outcome, count(*) AS runs, CAST(sum(n_bytes) AS BIGINT) AS bytes,
  round(quantile_cont(duration_ms, 0.5), 6) AS p50, round(quantile_cont(duration_ms, 0.95), 6) AS p95,
  round(quantile_cont(duration_ms, 0.99), 6) AS p99
FROM (SELECT * REPLACE (CAST(duration_ms AS DOUBLE) AS duration_ms) FROM w_load_log)
WHERE layer = 'bronze' GROUP BY 1, 2
""")
def mon_bronze_stats(st: Stages):
    stats = monitor.duration_stats(
        st.load_log.where("layer = 'bronze'"), ["provider", "outcome"], "duration_ms", {"bytes": "bytes"}
    )
    return _quantiles_as_doubles(stats)


@query("mon_load_stats", """
SELECT layer, outcome, count(*) AS runs, CAST(sum(n_rows) AS BIGINT) AS rows_loaded,
  round(quantile_cont(duration_ms, 0.5), 6) AS p50, round(quantile_cont(duration_ms, 0.95), 6) AS p95,
  round(quantile_cont(duration_ms, 0.99), 6) AS p99
FROM (SELECT * REPLACE (CAST(duration_ms AS DOUBLE) AS duration_ms) FROM w_load_log) GROUP BY 1, 2
""")
def mon_load_stats(st: Stages):
    stats = monitor.duration_stats(
        st.load_log, ["layer", "outcome"], "duration_ms", {"rows_loaded": "rows"}
    )
    return _quantiles_as_doubles(stats)


@query("mon_replay_stats", """
SELECT source, status, count(*) AS runs, CAST(sum(events_replayed) AS BIGINT) AS events,
  round(quantile_cont(duration_ms, 0.5), 6) AS p50, round(quantile_cont(duration_ms, 0.95), 6) AS p95,
  round(quantile_cont(duration_ms, 0.99), 6) AS p99
FROM (SELECT * REPLACE (CAST(duration_ms AS DOUBLE) AS duration_ms) FROM w_job) GROUP BY 1, 2
""")
def mon_replay_stats(st: Stages):
    stats = monitor.duration_stats(
        st.replay_jobs, ["source", "status"], "duration_ms", {"events": "events_replayed"}
    )
    return _quantiles_as_doubles(stats)


def _quantiles_as_doubles(stats):
    for name in ("p50", "p95", "p99"):
        stats = stats.withColumn(name, F.round(F.col(name).cast("double"), 6))
    return stats


@query("mon_triage", """
SELECT h.provider,
  CASE WHEN age < 300 THEN 'healthy' ELSE 'concerning' END AS status_check,
  CASE WHEN recent = 0 THEN 'concerning' ELSE 'healthy' END AS volume_check,
  CASE WHEN dlq_rate > 0.20 THEN 'concerning' WHEN dlq_rate < 0.05 THEN 'healthy' ELSE 'watch' END
    AS dlq_check,
  CASE WHEN p50 < 0.60 THEN 'concerning' WHEN p50 > 0.90 THEN 'healthy' ELSE 'watch' END
    AS quality_check,
  CASE WHEN age > 600 THEN 'concerning' WHEN age <= 300 THEN 'healthy' ELSE 'watch' END AS age_check
FROM (SELECT provider, count(*) FILTER (received_at > as_of - INTERVAL 60 SECOND) AS recent,
        (epoch_us(any_value(as_of)) - epoch_us(max(received_at))) / 1e6 AS age
      FROM w_curve, w_clock GROUP BY provider) h
LEFT JOIN (
  SELECT provider, count(*) FILTER (outcome = 'failed') / count(*) AS dlq_rate,
    quantile_cont(CAST(score AS DOUBLE), 0.5) AS p50
  FROM (SELECT o.*, p.score FROM w_outcome o LEFT JOIN w_passed p USING (seq)) x, w_clock
  WHERE x.received_at > as_of - INTERVAL 1 DAY GROUP BY provider) q USING (provider)
""")
def mon_triage(st: Stages):
    return monitor.triage(
        serving.provider_health(st.kept.curves_unversioned, st.as_of),
        serving.provider_quality(st.kept.outcomes, st.as_of, DAY),
        st.as_of,
    )


# -- alert rules -------------------------------------------------------------


@query("alert_dlq_ratio", """
SELECT provider, date_trunc('minute', received_at) AS window_start,
  round(count(*) FILTER (outcome = 'failed') / count(*), 6) AS dlq_ratio
FROM w_outcome GROUP BY 1, 2 HAVING count(*) FILTER (outcome = 'failed') / count(*) > 0.20
""")
def alert_dlq_ratio(st: Stages):
    return alerts.dlq_ratio(st.outcomes).withColumn("dlq_ratio", F.round("dlq_ratio", 6))


@query("alert_low_quality", """
SELECT provider, to_timestamp(epoch_us(received_at) // 300000000 * 300)::TIMESTAMP AS window_start,
  round(quantile_cont(CAST(score AS DOUBLE), 0.5), 6) AS quality_p50
FROM w_passed GROUP BY 1, 2 HAVING round(quantile_cont(CAST(score AS DOUBLE), 0.5), 6) < 0.8
""")
def alert_low_quality(st: Stages):
    return alerts.low_quality(st.outcomes, limit=0.8).withColumn(
        "quality_p50", F.round("quality_p50", 6)
    )


@query("alert_provider_outage", """
SELECT provider, last_event_at, last_event_at + INTERVAL 240 SECOND AS starts_at,
  resumed_at AS ends_at, round(gap_seconds, 6) AS gap_seconds
FROM w_gap WHERE gap_seconds > 240
""")
def alert_provider_outage(st: Stages):
    return alerts.provider_outage(st.raw, st.alert_clock).withColumn("gap_seconds", F.round("gap_seconds", 6))


@query("alert_dlq_spike", """
SELECT provider, eval_time, letters, round(per_minute::DOUBLE, 6) AS per_minute FROM w_eval_spike
WHERE per_minute > 0.004
""")
def alert_dlq_spike(st: Stages):
    return alerts.dlq_spike(st.dead_letters, 6 * HOUR, HOUR, 0.004).withColumn(
        "per_minute", F.round("per_minute", 6)
    )


@query("alert_dlq_critical", """
SELECT provider, eval_time, letters, round(per_minute::DOUBLE, 6) AS per_minute FROM w_eval_critical
WHERE per_minute > 0.006
""")
def alert_dlq_critical(st: Stages):
    return alerts.dlq_critical(st.dead_letters, 12 * HOUR, HOUR, 0.006).withColumn(
        "per_minute", F.round("per_minute", 6)
    )


@query("alert_stale_curve", """
SELECT instrument, provider, max(received_at) AS last_event_at,
  round((epoch_us(any_value(as_of)) - epoch_us(max(received_at))) / 1e6, 6) AS age_seconds
FROM w_raw, w_clock WHERE received_at > as_of - INTERVAL 1 DAY GROUP BY 1, 2
HAVING (epoch_us(any_value(as_of)) - epoch_us(max(received_at))) / 1e6 > 600
""")
def alert_stale_curve(st: Stages):
    return alerts.stale_curves(st.raw, st.as_of, lookback_seconds=DAY).withColumn(
        "age_seconds", F.round("age_seconds", 6)
    )


@query("alert_malformed_rate", """
SELECT provider, eval_time, malformed, ingested, round(ratio, 6) AS ratio FROM w_eval_malformed
WHERE ratio > 0.05
""")
def alert_malformed_rate(st: Stages):
    return (
        alerts.malformed_evaluations(st.outcomes, 6 * HOUR, HOUR, 0.05)
        .where("firing")
        .drop("firing")
        .withColumn("ratio", F.round("ratio", 6))
    )


@query("alert_replay_failed", """
SELECT source, count(*) AS failures FROM w_job, w_clock
WHERE requested_at > as_of - INTERVAL 10 DAY AND status = 'failed' GROUP BY source
""")
def alert_replay_failed(st: Stages):
    return alerts.failures_since(
        st.replay_jobs, "requested_at", "status", st.as_of, 10 * DAY, ["source"]
    )


@query("alert_load_failed", """
SELECT layer, count(*) AS failures FROM w_load_log, w_clock
WHERE loaded_at > as_of - INTERVAL 1 DAY AND outcome = 'failed' GROUP BY layer
""")
def alert_load_failed(st: Stages):
    return alerts.failures_since(st.load_log, "loaded_at", "outcome", st.as_of, DAY, ["layer"])


@query("alert_write_latency", """
SELECT to_timestamp(epoch_us(loaded_at) // 21600000000 * 21600)::TIMESTAMP AS window_start,
  round(quantile_cont(CAST(duration_ms AS DOUBLE), 0.95), 6) AS p95
FROM w_load_log WHERE layer = 'bronze' GROUP BY 1
HAVING quantile_cont(CAST(duration_ms AS DOUBLE), 0.95) > 4500
""")
def alert_write_latency(st: Stages):
    writes = st.load_log.where("layer = 'bronze'")
    return alerts.slow_writes(writes, 6 * HOUR, 4500.0).select("window_start", r6("p95"))


@query("alert_hold", """
SELECT provider, pending_from, starts_at, ends_at, evaluations FROM w_held_spike
""")
def alert_hold(st: Stages):
    return alerts.held(
        alerts.dlq_rate_evaluations(st.dead_letters, 6 * HOUR, HOUR, 0.004), ["provider"], HOUR, HOUR
    ).select("provider", "pending_from", "starts_at", "ends_at", "evaluations")


@query("alert_group", """
SELECT alertname, component, severity, count(*) AS alerts,
  string_agg(DISTINCT provider, ',' ORDER BY provider) AS providers,
  min(starts_at) AS first_start, max(ends_at) AS last_end
FROM w_alert GROUP BY 1, 2, 3
""")
def alert_group(st: Stages):
    return alerts.grouped(st.alerts)


@query("alert_inhibit", """
SELECT alertname, component, severity, provider, starts_at, ends_at FROM w_alert w
WHERE severity = 'critical' OR NOT EXISTS (
  SELECT 1 FROM w_alert c WHERE c.severity = 'critical'
    AND (c.component = w.component OR c.alertname = w.alertname)
    AND w.starts_at <= c.ends_at AND c.starts_at <= w.ends_at)
""")
def alert_inhibit(st: Stages):
    return alerts.inhibited(st.alerts)


@query("alert_flatten", """
SELECT 'ops-' || severity AS receiver, alertname, severity, 'firing' AS status,
  'Alert from ' || provider AS summary, starts_at, ends_at FROM w_alert
""")
def alert_flatten(st: Stages):
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    labels = F.create_map(F.lit("alertname"), "alertname", F.lit("severity"), "severity")
    one = F.struct(
        F.lit("firing").alias("status"),
        labels.alias("labels"),
        F.create_map(F.lit("summary"), F.concat(F.lit("Alert from "), "provider")).alias(
            "annotations"
        ),
        F.date_format("starts_at", iso).alias("startsAt"),
        F.date_format("ends_at", iso).alias("endsAt"),
    )
    # One webhook call per severity and day of start.
    hooks = (
        st.alerts.withColumn("_alert", one)
        .groupBy("severity", F.to_date("starts_at"))
        .agg(F.collect_list("_alert").alias("alerts"))
        .select(
            F.to_json(
                F.struct(
                    F.concat(F.lit("ops-"), "severity").alias("receiver"),
                    F.lit("firing").alias("status"),
                    "alerts",
                )
            ).alias("payload")
        )
    )
    return alerts.flatten(hooks)
