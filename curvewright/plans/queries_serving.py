"""Serving-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvewright.operators import serving
from curvewright.plans.oracle_ctes import define
from curvewright.plans.registry import query, r6
from curvewright.plans.stages import DAY, Stages

# Half-complete curves are served here so that most instruments qualify.
HALF = 0.5

define("w_latest", """
SELECT instrument, tenor, price, quality_score, event_timestamp AS last_updated FROM (
  SELECT *, row_number() OVER (PARTITION BY instrument, tenor ORDER BY received_at DESC, seq DESC)
    AS rn FROM w_curve) WHERE rn = 1
""")
define("w_served", """
SELECT l.instrument, count(*) AS tenor_count, any_value(f.curve_name) AS curve_name,
  any_value(f.provider) AS provider, any_value(f.event_timestamp) AS as_of,
  any_value(f.version) AS version,
  least(1.0, count(*) / any_value(u.serving_expected)) AS completeness
FROM w_latest l
JOIN (SELECT *, row_number() OVER (PARTITION BY instrument ORDER BY received_at DESC, seq DESC) AS rn
      FROM w_curve) f ON f.instrument = l.instrument AND f.rn = 1
JOIN w_unit u ON u.canonical = l.instrument
GROUP BY l.instrument
""")


@query("srv_latest", """
SELECT instrument, tenor, price, CAST(quality_score AS DOUBLE) AS quality_score, last_updated
FROM w_latest
""")
def srv_latest(st: Stages):
    unversioned = st.curves_unversioned.withColumn("version", F.lit(0))
    return serving.latest_prices(unversioned).drop("last")


@query("srv_history", """
SELECT instrument, event_id, epoch_us(event_timestamp) // 1000 AS event_timestamp_ms FROM w_curve
QUALIFY row_number() OVER (PARTITION BY instrument
  ORDER BY epoch_us(event_timestamp) // 1000 DESC, event_id DESC) <= 1000
""")
def srv_history(st: Stages):
    return serving.history(st.curves_unversioned).select(
        "instrument", "event_id", "event_timestamp_ms"
    )


@query("srv_snapshot", """
SELECT instrument, curve_name, provider, as_of, CAST(version AS BIGINT) AS version, tenor_count,
  round(completeness, 6) AS completeness, true AS is_authoritative
FROM w_served WHERE completeness >= 0.80
""")
def srv_snapshot(st: Stages):
    return serving.snapshots(st.curves).select(
        "instrument",
        "curve_name",
        "provider",
        "as_of",
        "version",
        "tenor_count",
        r6("completeness"),
        "is_authoritative",
    )


@query("srv_health", """
SELECT provider, last_event_at, events_last_60s,
  CASE WHEN age < 300 THEN 'healthy' WHEN age < 900 THEN 'degraded' ELSE 'outage' END AS status
FROM (
  SELECT provider, max(received_at) AS last_event_at,
    count(*) FILTER (received_at > as_of - INTERVAL 60 SECOND) AS events_last_60s,
    (epoch_us(any_value(as_of)) - epoch_us(max(received_at))) / 1e6 AS age
  FROM w_curve, w_clock GROUP BY provider)
""")
def srv_health(st: Stages):
    return serving.provider_health(st.curves_unversioned, st.as_of)


@query("srv_health_quality", """
SELECT provider, count(*) AS events,
  round(count(*) FILTER (outcome = 'failed') / count(*), 6) AS dlq_rate,
  round(quantile_cont(CAST(score AS DOUBLE), 0.5), 6) AS quality_p50,
  round(quantile_cont(CAST(score AS DOUBLE), 0.95), 6) AS quality_p95
FROM (SELECT o.*, p.score FROM w_outcome o LEFT JOIN w_passed p USING (seq)) x, w_clock
WHERE x.received_at > as_of - INTERVAL 1 DAY GROUP BY provider
""")
def srv_health_quality(st: Stages):
    return serving.provider_quality(st.outcomes, st.as_of, DAY).select(
        "provider", "events", r6("dlq_rate"), r6("quality_p50"), r6("quality_p95")
    )


@query("srv_minute_counts", """
SELECT provider, date_trunc('minute', received_at) AS minute, count(*) AS events
FROM w_curve, w_clock WHERE received_at > as_of - INTERVAL 3 DAY GROUP BY ALL
""")
def srv_minute_counts(st: Stages):
    return serving.minute_counts(st.curves_unversioned, st.as_of, 3 * DAY)


@query("srv_stale", """
SELECT instrument, max(event_timestamp) AS newest_event FROM w_curve GROUP BY instrument
HAVING epoch_us((SELECT as_of FROM w_clock)) - epoch_us(max(event_timestamp)) > 600 * 1000000
""")
def srv_stale(st: Stages):
    return serving.stale_instruments(st.curves_unversioned, st.as_of)


@query("srv_stale_report", """
SELECT s.instrument, s.newest_event, v.as_of AS last_event_at,
  round((epoch_us((SELECT as_of FROM w_clock)) - epoch_us(v.as_of)) / 1e6, 1) AS staleness_seconds
FROM (SELECT instrument, max(event_timestamp) AS newest_event FROM w_curve GROUP BY instrument
      HAVING epoch_us((SELECT as_of FROM w_clock)) - epoch_us(max(event_timestamp)) > 600 * 1000000) s
LEFT JOIN (SELECT * FROM w_served WHERE completeness >= 0.5) v USING (instrument)
""")
def srv_stale_report(st: Stages):
    unversioned = st.curves_unversioned.withColumn("version", F.lit(0))
    return serving.stale_report(unversioned, st.as_of, completeness=HALF)
