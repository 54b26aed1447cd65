"""Reporting-view and ad-hoc read queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvewright.operators import quality, serving, views
from curvewright.plans import queries_serving, queries_stages
from curvewright.plans.oracle_ctes import define
from curvewright.plans.registry import _SQL, query, r6
from curvewright.plans.stages import Stages

HALF = queries_serving.HALF

define("w_history", _SQL["quality_history"])
define("w_dlq_table", "SELECT * FROM w_dlq")
define("w_latest_curve", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY provider, instrument, curve_date ORDER BY snapshot_time DESC, snapshot_id) AS rn
  FROM w_gold) WHERE rn = 1
""")
define("w_silver", """
SELECT *, 'bronze/provider=' || provider || '/dt=' || strftime(received_at, '%Y-%m-%d') || '/hh='
  || strftime(received_at, '%H') AS bronze_key, 'PASSED' AS validation_status FROM w_curve
""")


@query("view_latest_curves", """
SELECT snapshot_id, provider, instrument, strftime(curve_date, '%Y-%m-%d') AS curve_date, curve_name,
  round(front_price, 6) AS front_price, round(curve_slope, 6) AS curve_slope,
  CAST(num_tenors AS BIGINT) AS num_tenors, round(quality_score, 6) AS quality_score,
  round(completeness_pct, 6) AS completeness_pct, snapshot_time
FROM w_latest_curve
""")
def view_latest_curves(st: Stages):
    return views.latest_curves(st.gold).select(
        "snapshot_id",
        "provider",
        "instrument",
        "curve_date",
        "curve_name",
        r6("front_price"),
        r6("curve_slope"),
        "num_tenors",
        r6("quality_score"),
        r6("completeness_pct"),
        "snapshot_time",
    )


@query("view_quality_summary", """
SELECT provider, quality_date, avg_quality_score, CAST(total_events AS BIGINT) AS total_events,
  CAST(total_dlq AS BIGINT) AS total_dlq, CAST(total_warnings AS BIGINT) AS total_warnings,
  avg_completeness_pct, avg_latency_ms, max_p99_latency_ms, dlq_rate_pct,
  round(d, 4) AS quality_score_delta,
  CASE WHEN d > 0.01 THEN 'IMPROVING' WHEN d < -0.01 THEN 'DEGRADING' ELSE 'STABLE' END AS trend
FROM (
  SELECT *, q - lag(q) OVER (PARTITION BY provider ORDER BY quality_date) AS d FROM (
    SELECT provider, date_trunc('day', window_start) AS quality_date, avg(quality_score) AS q,
      round(avg(quality_score), 4) AS avg_quality_score, sum(events_count) AS total_events,
      sum(dlq_count) AS total_dlq, sum(warning_count) AS total_warnings,
      round(avg(completeness_pct), 2) AS avg_completeness_pct,
      round(avg(avg_latency_ms), 2) AS avg_latency_ms,
      round(max(p99_latency_ms), 2) AS max_p99_latency_ms,
      round(CAST(sum(dlq_count) AS DOUBLE) * 100.0 / nullif(sum(events_count), 0), 4)
        AS dlq_rate_pct
    FROM w_history, w_clock
    WHERE measurement_window = 'DAILY' AND window_start >= as_of - INTERVAL 7 DAY
    GROUP BY 1, 2))
""")
def view_quality_summary(st: Stages):
    return views.quality_summary(quality.quality_history(st.kept.outcomes, st.kept.gold), st.as_of)


@query("view_dlq_summary", """
SELECT provider, failure_category,
  count(*) FILTER (dlq_timestamp >= as_of - INTERVAL 24 HOUR) AS events_last_24h,
  count(*) FILTER (dlq_timestamp >= as_of - INTERVAL 7 DAY) AS events_last_7d,
  count(*) AS events_total, min(dlq_timestamp) AS first_seen, max(dlq_timestamp) AS last_seen,
  count(*) FILTER (retry_status = 'RESOLVED') AS resolved_count,
  count(*) FILTER (retry_status = 'PENDING') AS pending_count,
  count(*) FILTER (retry_status = 'ABANDONED') AS abandoned_count,
  round(CAST(count(*) FILTER (retry_status = 'RESOLVED') AS DOUBLE) * 100.0 / count(*), 2)
    AS resolution_rate_pct
FROM w_dlq_table, w_clock GROUP BY provider, failure_category
""")
def view_dlq_summary(st: Stages):
    return views.dlq_summary(st.dlq_table, st.as_of)


@query("view_curve_completeness", """
SELECT provider, instrument, count(*) AS expected_slots, count(filled) AS filled_slots,
  round(count(filled) * 100.0::DOUBLE / count(*), 2) AS completeness_pct,
  round(avg(q), 4) AS avg_quality_score, round(avg(c), 2) AS avg_curve_completeness_pct,
  CASE WHEN count(filled) * 100.0 / count(*) >= 95 THEN 'GREEN'
       WHEN count(filled) * 100.0 / count(*) >= 80 THEN 'AMBER' ELSE 'RED' END AS rag_status,
  min(CASE WHEN filled IS NULL THEN slot END) AS first_gap,
  max(CASE WHEN filled IS NULL THEN slot END) AS last_gap
FROM (
  SELECT i.provider, i.instrument, date_trunc('hour', as_of) - to_hours(h.range) AS slot
  FROM (SELECT DISTINCT provider, instrument FROM w_gold
        WHERE snapshot_time >= (SELECT as_of FROM w_clock) - INTERVAL 24 HOUR) i, range(24) h, w_clock) e
LEFT JOIN (
  SELECT provider, instrument, date_trunc('hour', snapshot_time) AS slot, 1 AS filled,
    max(quality_score) AS q, max(completeness_pct) AS c
  FROM w_gold WHERE snapshot_time >= (SELECT as_of FROM w_clock) - INTERVAL 24 HOUR GROUP BY 1, 2, 3) a
USING (provider, instrument, slot)
GROUP BY provider, instrument
""")
def view_curve_completeness(st: Stages):
    return views.curve_completeness(st.gold, st.as_of)


@query("q_curve_list", """
SELECT instrument, curve_name, provider, as_of, round(completeness, 6) AS completeness, tenor_count,
  CAST(version AS BIGINT) AS version, true AS is_authoritative
FROM w_served WHERE completeness >= 0.5
""")
def q_curve_list(st: Stages):
    return views.curve_list(serving.snapshots(st.curves, HALF)).withColumn(
        "completeness", F.round("completeness", 6)
    )


@query("q_curve_get", """
SELECT s.instrument, s.curve_name, s.as_of, CAST(s.version AS BIGINT) AS version, l.tenor, l.price,
  CAST(l.quality_score AS DOUBLE) AS quality_score, l.last_updated
FROM w_served s JOIN w_latest l USING (instrument)
WHERE s.completeness >= 0.5 AND instrument = 'TTF'
""")
def q_curve_get(st: Stages):
    return views.curve_get(serving.snapshots(st.curves, HALF), "TTF")


@query("q_curve_history", """
SELECT event_id, tenor, price, epoch_us(event_timestamp) // 1000 AS event_timestamp_ms FROM w_curve
WHERE instrument = 'NBP' ORDER BY epoch_us(event_timestamp) // 1000 DESC, event_id DESC LIMIT 20
""")
def q_curve_history(st: Stages):
    return views.curve_history(st.curves_unversioned, "NBP").select(
        "event_id", "tenor", "price", "event_timestamp_ms"
    )


@query("q_providers", """
SELECT provider, last_event_at, events_last_60s,
  CASE WHEN age < 300 THEN 'healthy' WHEN age < 900 THEN 'degraded'
       WHEN age IS NULL THEN 'unknown' ELSE 'outage' END AS status
FROM (
  SELECT k.provider, max(c.received_at) AS last_event_at,
    count(*) FILTER (c.received_at > as_of - INTERVAL 60 SECOND) AS events_last_60s,
    (epoch_us(any_value(as_of)) - epoch_us(max(c.received_at))) / 1e6 AS age
  FROM (SELECT DISTINCT provider FROM w_raw) k CROSS JOIN w_clock
  LEFT JOIN w_curve c ON c.provider = k.provider GROUP BY k.provider)
""")
def q_providers(st: Stages):
    return views.providers(serving.provider_health(st.curves_unversioned, st.as_of, st.raw))


@query("q_dlq_stats", """
SELECT 'depth' AS part, NULL AS label, count(*) AS n FROM w_dlq
UNION ALL SELECT 'category', failure_category, count(*) FROM w_dlq GROUP BY failure_category
UNION ALL SELECT 'recent', dlq_event_id, epoch_us(dlq_timestamp) FROM (
  SELECT * FROM w_dlq ORDER BY dlq_timestamp DESC, dlq_event_id LIMIT 20)
""")
def q_dlq_stats(st: Stages):
    return views.dlq_stats(st.kept.dlq_table)


@query("q_dlq_list", """
SELECT dlq_event_id, dlq_timestamp, total, least(total, 20) AS returned FROM (
  SELECT *, count(*) OVER () AS total FROM w_dlq_table
  WHERE provider = 'provider-a' AND failure_category = 'stale' AND retry_status <> 'RESOLVED')
ORDER BY dlq_timestamp DESC, dlq_event_id LIMIT 20
""")
def q_dlq_list(st: Stages):
    return views.dlq_list(st.kept.dlq_table, 20, "provider-a", "stale", False).select(
        "dlq_event_id", "dlq_timestamp", "total", "returned"
    )


@query("q_dlq_breakdown", """
SELECT 'category' AS part, failure_category AS label, count(*) AS events,
  count(*) FILTER (retry_status <> 'RESOLVED') AS unreplayed,
  min(dlq_timestamp) AS oldest, max(dlq_timestamp) AS newest FROM w_dlq_table GROUP BY 2
UNION ALL SELECT 'provider', provider, count(*), count(*) FILTER (retry_status <> 'RESOLVED'),
  min(dlq_timestamp), max(dlq_timestamp) FROM w_dlq_table GROUP BY 2
UNION ALL SELECT 'all', NULL, count(*), count(*) FILTER (retry_status <> 'RESOLVED'),
  min(dlq_timestamp), max(dlq_timestamp) FROM w_dlq_table
""")
def q_dlq_breakdown(st: Stages):
    return views.dlq_breakdown(st.dlq_table)


@query("q_silver_profile", """
SELECT provider, instrument, count(*) AS total_events, min(event_timestamp) AS earliest,
  max(event_timestamp) AS latest, round(avg(CAST(quality_score AS DOUBLE)), 3) AS avg_quality
FROM w_silver GROUP BY ALL
""")
def q_silver_profile(st: Stages):
    return views.silver_profile(st.silver_unversioned)


@query("q_silver_freshness", """
SELECT count(*) AS total_rows, max(received_at) AS latest_event FROM w_silver
""")
def q_silver_freshness(st: Stages):
    return views.silver_freshness(st.silver_unversioned)


@query("q_quality_dist", """
SELECT instrument, validation_status, round(avg(CAST(quality_score AS DOUBLE)), 3) AS avg_quality,
  count(*) AS event_count FROM w_silver GROUP BY ALL
""")
def q_quality_dist(st: Stages):
    return views.quality_distribution(st.silver_unversioned)


@query("q_latest_prices", """
SELECT tenor, price, CAST(quality_score AS DOUBLE) AS quality_score, event_timestamp FROM w_silver
WHERE instrument = 'TTF' ORDER BY event_timestamp DESC, event_id LIMIT 24
""")
def q_latest_prices(st: Stages):
    return views.newest_prices(st.silver_unversioned, "TTF")


@query("q_gold_stats", """
SELECT count(*) AS total_snapshots, round(avg(completeness_pct), 3) AS avg_completeness,
  min(as_of) AS oldest_snapshot, max(as_of) AS newest_snapshot FROM w_gold
""")
def q_gold_stats(st: Stages):
    return views.gold_stats(st.gold)


@query("q_gold_latest_auth", """
SELECT instrument, curve_name, as_of, round(front_price, 6) AS front_price,
  CAST(num_tenors AS BIGINT) AS num_tenors, round(completeness_pct, 6) AS completeness_pct,
  round(quality_score, 6) AS quality_score
FROM w_gold WHERE is_authoritative ORDER BY as_of DESC, curve_name LIMIT 12
""")
def q_gold_latest_auth(st: Stages):
    return views.newest_authoritative(st.gold).select(
        "instrument",
        "curve_name",
        "as_of",
        r6("front_price"),
        "num_tenors",
        r6("completeness_pct"),
        r6("quality_score"),
    )


@query("q_gold_hist", """
SELECT round(completeness_pct, 6) AS completeness_pct, count(*) AS snapshots FROM w_gold GROUP BY 1
""")
def q_gold_hist(st: Stages):
    return views.completeness_histogram(
        st.gold.withColumn("completeness_pct", F.round("completeness_pct", 6))
    )


@query("q_gold_current", """
SELECT instrument, strftime(curve_date, '%Y-%m-%d') AS curve_date, round(front_price, 6) AS front_price,
  CAST(num_tenors AS BIGINT) AS num_tenors, round(quality_score, 3) AS quality,
  round(completeness_pct, 6) AS completeness_pct, snapshot_time, provider
FROM w_latest_curve
""")
def q_gold_current(st: Stages):
    return (
        views.current_curves(st.gold)
        .withColumn("front_price", F.round(F.col("front_price").cast("double"), 6))
        .withColumn("completeness_pct", F.round("completeness_pct", 6))
    )


@query("q_lineage", """
SELECT event_id, provider, instrument, tenor, price, CAST(quality_score AS DOUBLE) AS quality_score,
  bronze_key, trace_id FROM w_silver
WHERE bronze_key LIKE '%provider-b/dt=2024-01-1%' ORDER BY event_id LIMIT 10
""")
def q_lineage(st: Stages):
    return views.lineage(st.silver_unversioned, "provider-b/dt=2024-01-1")


@query("q_incomplete", """
SELECT curve_name, as_of, round(completeness, 6) AS completeness FROM w_gold
WHERE as_of BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AND completeness < 1.0
""")
def q_incomplete(st: Stages):
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-10", "2024-01-20"))
    return views.incomplete_snapshots(st.gold, start, end).select(
        "curve_name", "as_of", r6("completeness")
    )


@query("q_dup_silver", """
SELECT event_id, count(*) AS cnt FROM w_raw
WHERE received_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
GROUP BY event_id HAVING count(*) > 1 ORDER BY cnt DESC, event_id LIMIT 20
""")
def q_dup_silver(st: Stages):
    # Every raw row as if replayed without repeat detection.
    loaded = st.raw.withColumn("is_replay", F.lit(True)).withColumn(
        "validated_at", F.col("received_at")
    )
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-05", "2024-01-25"))
    return views.repeated_event_ids(loaded, start, end)


@query("q_dup_gold", """
SELECT curve_name, tenor, window_start AS as_of, count(*) AS cnt
FROM (SELECT curve_name, window_start, tenor FROM w_tenor_price
      UNION ALL SELECT curve_name, window_start, tenor FROM w_tenor_price
      WHERE day(window_start) = 15)
WHERE (curve_name, window_start) IN (SELECT (curve_name, as_of) FROM w_gold)
GROUP BY ALL HAVING count(*) > 1 ORDER BY cnt DESC, curve_name, tenor, as_of LIMIT 20
""")
def q_dup_gold(st: Stages):
    loaded = st.gold.unionByName(st.gold.where(F.dayofmonth("as_of") == 15))
    return views.repeated_gold_prices(loaded)
