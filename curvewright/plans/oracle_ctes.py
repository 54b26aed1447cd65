"""The derived feed and its stages written as plain SQL.

Each named table is a common table expression; :func:`sql` puts together the
ones a query needs. Written from the rules, not from the Spark plans, so that
the two can be compared.
"""

from __future__ import annotations

import re

DAY = 86_400

_CTES: dict[str, str] = {}


def define(name: str, text: str) -> None:
    _CTES[name] = text.strip()


def _needed(text: str, found: list[str]) -> None:
    for name in _CTES:
        if name not in found and re.search(rf"\b{name}\b", text):
            body = _CTES[name]
            # Recursive tables mention themselves; skip their own name.
            _needed(re.sub(rf"\b{name}\b", " ", body), found)
            if name not in found:
                found.append(name)


def sql(query: str) -> str:
    """``query`` preceded by every table it depends on, in definition order."""
    found: list[str] = []
    _needed(query, found)
    parts = [f"{name} AS ({_CTES[name]})" for name in _CTES if name in found]
    if not parts:
        return query.strip()
    # A query may go on with tables of its own.
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + query.strip()


def values(rows: list[tuple], names: str) -> str:
    body = ", ".join(
        "(" + ", ".join("NULL" if v is None else repr(v) for v in row) + ")" for row in rows
    )
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


define("w_base", """
SELECT event_id AS e, user_id AS u, ts, value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")

define("w_copies", """
SELECT *, 0 AS copy_no FROM w_base
UNION ALL SELECT *, 1 AS copy_no FROM w_base WHERE e % 50 = 7
""")

define("w_raw", """
SELECT e, copy_no, k, value,
  CASE WHEN e % 211 = 5 THEN '' ELSE 'ev-' || e END AS event_id,
  CASE WHEN e % 199 = 3 THEN '' ELSE 'provider-' || (['a','b','c'])[u % 3 + 1] END AS provider,
  (['TTF','NBP GAS',' brn ','CL','EUA','TTFPOWER','ttf_gas','UNKNOWN_X'])[u % 8 + 1] AS instrument,
  ts + to_seconds(e % 45 + CASE WHEN copy_no = 0 THEN 0 WHEN e % 100 = 57 THEN 7200 ELSE 50 END)
    AS received_at,
  CASE WHEN e % 101 = 0 THEN ts - INTERVAL 30 HOUR
       WHEN e % 103 = 0 THEN ts + INTERVAL 10 MINUTE ELSE ts END AS event_timestamp,
  (['2024-03','2024-4','MAY24','Jun-24','Jul-2024','August 2024','M+1','M+7','Q1-2024','2024Q3',
    'Q+2','Summer 2024','WIN25','Cal-2025','2026','spot','2024-13','GARBAGE','',NULL])[k % 20 + 1]
    AS raw_tenor,
  CASE WHEN e % 89 = 0 THEN 'text' WHEN e % 83 = 0 THEN 'null' WHEN e % 79 = 0 THEN 'absent'
       ELSE 'number' END AS price_kind,
  CASE WHEN e % 89 = 0 OR e % 83 = 0 OR e % 79 = 0 THEN NULL
       WHEN e % 97 = 0 THEN -value ELSE value END AS price,
  list_filter([
    CASE WHEN e % 101 = 0 THEN 'stale' END,
    CASE WHEN e % 103 = 0 THEN 'out_of_order' END,
    CASE WHEN e % 97 = 0 OR e % 89 = 0 THEN 'malformed' END,
    CASE WHEN e % 20 = 0 THEN 'delayed' END,
    CASE WHEN e % 37 = 0 THEN 'schema_drift' END,
    CASE WHEN e % 41 = 0 THEN 'partial_curve' END,
    CASE WHEN e % 50 = 7 THEN 'duplicate' END,
    CASE WHEN e % 60 = 0 THEN 'delayed' END], lambda f: f IS NOT NULL) AS faults,
  'tr-' || e AS trace_id,
  e * 2 + copy_no AS seq
FROM w_copies
""")

define("w_clock", "SELECT max(received_at) AS as_of FROM w_raw")

define("w_structure", """
SELECT *, epoch_us(received_at) // 1000 AS ms,
  CASE WHEN event_id = '' OR provider = '' THEN 'missing_required_field'
       WHEN price_kind = 'text' THEN 'schema_violation' END AS structure_category,
  CASE WHEN event_id = '' OR provider = '' THEN
         'Missing required fields: ' || concat_ws(', ',
           CASE WHEN event_id = '' THEN 'event_id' END,
           CASE WHEN provider = '' THEN 'provider' END)
       WHEN price_kind = 'text' THEN 'payload.price must be numeric, got str' END
    AS structure_reason
FROM w_raw
""")

# Acceptance anchors, one at a time per id: the first arrival, then the first
# arrival a full time to live after the last accepted one.
define("w_anchor", """
SELECT event_id, ms, seq FROM (
  SELECT event_id, ms, seq,
         row_number() OVER (PARTITION BY event_id ORDER BY received_at, seq) AS rn
  FROM w_structure WHERE structure_category IS NULL) WHERE rn = 1
UNION ALL
SELECT event_id, ms, seq FROM (
  SELECT s.event_id, s.ms, s.seq,
         row_number() OVER (PARTITION BY s.event_id ORDER BY s.received_at, s.seq) AS rn
  FROM w_anchor a JOIN w_structure s
    ON s.event_id = a.event_id AND s.structure_category IS NULL AND s.ms >= a.ms + 3600000)
WHERE rn = 1
""")

define("w_outcome", """
SELECT s.*,
  CASE WHEN structure_category IS NOT NULL THEN 'failed'
       WHEN a.seq IS NULL THEN 'duplicate'
       WHEN event_timestamp < received_at - INTERVAL 24 HOUR THEN 'failed'
       WHEN event_timestamp > received_at + INTERVAL 5 MINUTE THEN 'failed'
       WHEN price <= 0 OR price >= 1000000 THEN 'failed'
       ELSE 'passed' END AS outcome,
  CASE WHEN structure_category IS NOT NULL THEN structure_category
       WHEN a.seq IS NULL THEN NULL
       WHEN event_timestamp < received_at - INTERVAL 24 HOUR THEN 'stale'
       WHEN event_timestamp > received_at + INTERVAL 5 MINUTE THEN 'out_of_order'
       WHEN price <= 0 OR price >= 1000000 THEN 'malformed' END AS category,
  CASE WHEN structure_category IS NOT NULL THEN structure_reason
       WHEN a.seq IS NULL THEN NULL
       WHEN event_timestamp < received_at - INTERVAL 24 HOUR THEN
         printf('event_timestamp is %.1fh old, exceeds max age of 24h',
                round((epoch_us(received_at) - epoch_us(event_timestamp)) / 1e6 / 3600, 1))
       WHEN event_timestamp > received_at + INTERVAL 5 MINUTE THEN
         printf('event_timestamp is %.1fmin in the future, exceeds max of 5min',
                round((epoch_us(event_timestamp) - epoch_us(received_at)) / 1e6 / 60, 1))
       WHEN price <= 0 THEN 'payload.price ' || CAST(price AS VARCHAR) || ' must be > 0.0'
       WHEN price >= 1000000 THEN
         'payload.price ' || CAST(price AS VARCHAR) || ' must be < 1000000.0' END AS reason,
  (epoch_us(received_at) - epoch_us(event_timestamp)) / 1000 AS latency_ms
FROM w_structure s LEFT JOIN w_anchor a ON a.event_id = s.event_id AND a.seq = s.seq
""")

define("w_passed", """
SELECT *, md5('validated|' || event_id || '|' || seq) AS validated_id,
  greatest(0, 100 - list_sum(list_transform(faults || ['none'], lambda f:
    CASE f WHEN 'duplicate' THEN 30 WHEN 'malformed' THEN 50 WHEN 'schema_drift' THEN 20
           WHEN 'stale' THEN 25 WHEN 'out_of_order' THEN 25 WHEN 'delayed' THEN 10
           WHEN 'missing_field' THEN 40 WHEN 'partial_curve' THEN 15 ELSE 0 END))) / 100.0
    AS score
FROM w_outcome WHERE outcome = 'passed'
""")

define("w_dlq", """
SELECT md5('dlq|' || event_id || '|' || seq) AS dlq_event_id, event_id AS original_event_id,
  provider, instrument, reason AS failure_reason, category AS failure_category,
  received_at AS dlq_timestamp, trace_id, e, seq,
  CAST(e % 4 AS BIGINT) AS retry_count,
  (['PENDING','RETRYING','RESOLVED','ABANDONED'])[e % 4 + 1] AS retry_status
FROM w_outcome WHERE outcome = 'failed'
""")

define("w_alias", values([
    ("TTF", "TTF"), ("TTF GAS", "TTF"), ("TTF_GAS", "TTF"), ("NBP", "NBP"), ("NBP GAS", "NBP"),
    ("TTF_POWER", "TTF_POWER"), ("TTFPOWER", "TTF_POWER"), ("EEX_POWER", "TTF_POWER"),
    ("BRENT", "BRENT"), ("BRN", "BRENT"), ("CO", "BRENT"), ("WTI", "WTI"), ("CL", "WTI"),
    ("EUA", "EU_ETS"), ("EU_ETS", "EU_ETS"), ("CO2", "EU_ETS")], "alias, canonical"))

define("w_unit", values([
    ("TTF", "EUR", "MWh", 24), ("NBP", "EUR", "MWh", 24), ("TTF_POWER", "EUR", "MWh", 32),
    ("BRENT", "USD", "bbl", 24), ("WTI", "USD", "bbl", 24), ("EU_ETS", "EUR", "tonne", 5)],
    "canonical, currency, unit, serving_expected"))

define("w_month", values(
    [(n, i) for i, n in enumerate(
        ("january", "february", "march", "april", "may", "june", "july", "august",
         "september", "october", "november", "december"), 1)], "month_name, month_no"))

# Tenor text, read by regular expressions in their order of precedence.
define("w_tenor", r"""
SELECT *, CASE
  WHEN regexp_matches(t, '^m\+\d+$') THEN
    strftime(date_trunc('month', received_at)
             + to_months(CAST(substr(t, 3) AS INTEGER)), '%Y-%m')
  WHEN regexp_matches(t, '^q\+\d+$') THEN
    year(date_trunc('quarter', received_at) + to_months(3 * CAST(substr(t, 3) AS INTEGER)))
    || '-Q' ||
    quarter(date_trunc('quarter', received_at) + to_months(3 * CAST(substr(t, 3) AS INTEGER)))
  WHEN t IN ('spot', 'd+1') THEN 'spot'
  WHEN regexp_matches(t, '^\d{4}-\d{1,2}$') THEN
    CASE WHEN CAST(substr(t, 6) AS INTEGER) BETWEEN 1 AND 12
         THEN substr(t, 1, 4) || '-' || lpad(substr(t, 6), 2, '0') END
  WHEN regexp_matches(t, '^[a-z]{3}\d{2}$') AND month_of IS NOT NULL
    THEN '20' || right(t, 2) || '-' || month_of
  WHEN regexp_matches(t, '^[a-z]{3}-(\d{2}|\d{4})$') AND month_of IS NOT NULL
    THEN CASE WHEN length(t) = 8 THEN right(t, 4) ELSE '20' || right(t, 2) END || '-' || month_of
  WHEN regexp_matches(t, '^[a-z]+\s+\d{4}$') AND full_month IS NOT NULL
    THEN right(t, 4) || '-' || full_month
  WHEN regexp_matches(t, '^q[1-4][\s\-]\d{4}$') THEN right(t, 4) || '-Q' || substr(t, 2, 1)
  WHEN regexp_matches(t, '^\d{4}-?q[1-4]$') THEN substr(t, 1, 4) || '-Q' || right(t, 1)
  WHEN regexp_matches(t, '^summer\s+\d{4}$') THEN right(t, 4) || '-SUM'
  WHEN regexp_matches(t, '^sum\d{2}$') THEN '20' || right(t, 2) || '-SUM'
  WHEN regexp_matches(t, '^winter\s+\d{4}$') THEN right(t, 4) || '-WIN'
  WHEN regexp_matches(t, '^win\d{2}$') THEN '20' || right(t, 2) || '-WIN'
  WHEN regexp_matches(t, '^cal-\d{4}$') THEN right(t, 4) || '-CAL'
  WHEN regexp_matches(t, '^cal\d{2}$') THEN '20' || right(t, 2) || '-CAL'
  WHEN regexp_matches(t, '^\d{4}$') THEN t || '-CAL' END AS tenor
FROM (
  SELECT p.*, x.t,
    (SELECT lpad(CAST(m.month_no AS VARCHAR), 2, '0') FROM w_month m
     WHERE substr(m.month_name, 1, 3) = substr(x.t, 1, 3)) AS month_of,
    (SELECT lpad(CAST(m.month_no AS VARCHAR), 2, '0') FROM w_month m
     WHERE m.month_name = regexp_extract(x.t, '^[a-z]+')) AS full_month
  FROM w_passed p
  JOIN (SELECT seq, lower(trim(CASE WHEN raw_tenor IS NULL THEN 'None'
                                    WHEN raw_tenor = '' THEN instrument
                                    ELSE raw_tenor END)) AS t FROM w_passed) x USING (seq))
""")

define("w_interpreted", """
SELECT t.*, a.canonical,
  CASE WHEN a.canonical IS NULL THEN 'unknown_instrument'
       WHEN price IS NULL THEN 'missing_price'
       WHEN tenor IS NULL THEN 'unknown_tenor' END AS reject_reason
FROM w_tenor t LEFT JOIN w_alias a ON a.alias = upper(trim(t.instrument))
""")

define("w_curve", """
SELECT *, row_number() OVER (PARTITION BY curve_name ORDER BY received_at, seq) AS version
FROM (
  SELECT md5('curve|' || validated_id) AS event_id, validated_id AS source_event_id,
    i.canonical || '_' || upper(delivery_period) || '_FWD' AS curve_name,
    i.canonical AS instrument, tenor, delivery_period, CAST(price AS DOUBLE) AS price,
    u.currency, u.unit, provider, event_timestamp, received_at,
    greatest(0, 100
      - CASE WHEN list_contains(faults, 'delayed') THEN 5 ELSE 0 END
      - CASE WHEN list_contains(faults, 'schema_drift') THEN 20 ELSE 0 END
      - CASE WHEN list_contains(faults, 'stale') THEN 30 ELSE 0 END
      - CASE WHEN list_contains(faults, 'partial_curve') THEN 25 ELSE 0 END
      - CASE WHEN list_contains(faults, 'out_of_order') THEN 10 ELSE 0 END) / 100.0
      AS quality_score,
    trace_id, seq, e
  FROM (SELECT *, CASE WHEN tenor = 'spot' THEN 'spot' WHEN tenor LIKE '%-CAL' THEN 'annual'
                       WHEN tenor LIKE '%-SUM' OR tenor LIKE '%-WIN' THEN 'seasonal'
                       WHEN tenor LIKE '%-Q_' THEN 'quarterly' ELSE 'monthly' END
                  AS delivery_period
        FROM w_interpreted WHERE reject_reason IS NULL) i
  JOIN w_unit u ON u.canonical = i.canonical)
""")

define("w_tenor_price", """
SELECT curve_name, date_trunc('day', event_timestamp) AS window_start, tenor,
  arg_max(price, received_at::VARCHAR || lpad(seq::VARCHAR, 20, '0')) AS price,
  arg_max(quality_score, received_at::VARCHAR || lpad(seq::VARCHAR, 20, '0')) AS quality_score,
  arg_max(event_timestamp, received_at::VARCHAR || lpad(seq::VARCHAR, 20, '0')) AS last_updated,
  min(strftime(received_at, '%Y-%m-%d %H:%M:%S.%f') || lpad(seq::VARCHAR, 20, '0')) AS first_key,
  arg_min(provider, strftime(received_at, '%Y-%m-%d %H:%M:%S.%f')
          || lpad(seq::VARCHAR, 20, '0')) AS first_provider,
  arg_min(instrument, strftime(received_at, '%Y-%m-%d %H:%M:%S.%f')
          || lpad(seq::VARCHAR, 20, '0')) AS first_instrument,
  max(version) AS version, count(*) AS n_events
FROM w_curve GROUP BY ALL
""".replace("received_at::VARCHAR || lpad", "strftime(received_at, '%Y-%m-%d %H:%M:%S.%f') || lpad"))

define("w_window", """
SELECT *, max(num_tenors) OVER (PARTITION BY curve_name ORDER BY window_start) AS expected
FROM (
  SELECT curve_name, window_start, count(*) AS num_tenors, max(version) AS version,
    min(quality_score) AS min_quality, avg(quality_score) AS avg_quality,
    arg_min(first_provider, first_key) AS provider,
    arg_min(first_instrument, first_key) AS instrument,
    sum(n_events) AS n_events
  FROM w_tenor_price GROUP BY ALL)
""")

define("w_snapshot", """
SELECT *, least(1.0, num_tenors / expected) AS completeness,
  least(1.0, num_tenors / expected) >= 0.95 AND min_quality >= 0.70 AS is_authoritative
FROM w_window
""")

# Delivery start of each tenor, then first/last price, spread and staleness.
define("w_shape_row", """
SELECT curve_name, window_start, price, last_updated,
  CASE WHEN tenor = 'spot' THEN '0000-00'
       WHEN tenor LIKE '%-CAL' THEN substr(tenor, 1, 4) || '-01'
       WHEN tenor LIKE '%-SUM' THEN substr(tenor, 1, 4) || '-04'
       WHEN tenor LIKE '%-WIN' THEN substr(tenor, 1, 4) || '-10'
       WHEN tenor LIKE '%-Q_' THEN substr(tenor, 1, 4) || '-'
            || lpad(CAST(CAST(right(tenor, 1) AS INTEGER) * 3 - 2 AS VARCHAR), 2, '0')
       ELSE tenor END AS starts,
  median(price) OVER (PARTITION BY curve_name, window_start) AS mid,
  max(last_updated) OVER (PARTITION BY curve_name, window_start) AS newest
FROM w_tenor_price
""")

define("w_shape", """
SELECT curve_name, window_start, arg_min(price, starts) AS front_price,
  CASE WHEN count(*) > 1
       THEN (arg_max(price, starts) - arg_min(price, starts)) / (count(*) - 1) END AS curve_slope,
  count(*) FILTER (last_updated + INTERVAL 12 HOUR < newest) AS stale_tenors,
  count(*) FILTER (abs(price - mid) > 3.0 * mad_price) AS outlier_tenors
FROM (SELECT *, median(abs(price - mid)) OVER (PARTITION BY curve_name, window_start) AS mad_price
      FROM w_shape_row)
GROUP BY ALL
""")

define("w_gold", """
SELECT md5('snapshot|' || s.curve_name || '|' || epoch_us(s.window_start)) AS snapshot_id,
  s.curve_name, s.instrument, s.provider, s.window_start AS as_of,
  s.window_start AS snapshot_time, CAST(s.window_start AS DATE) AS curve_date,
  h.front_price, h.curve_slope, s.num_tenors, s.completeness,
  s.completeness * 100 AS completeness_pct, s.avg_quality AS quality_score,
  s.is_authoritative, s.version, h.stale_tenors, h.outlier_tenors
FROM w_snapshot s JOIN w_shape h USING (curve_name, window_start)
WHERE s.completeness >= 0.80
""")
