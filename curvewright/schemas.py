"""Record schemas and the fixed domain values shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Results depend on these exact names and numbers.
# --------------------------------------------------------------------------

DELIVERY_PERIODS = ("spot", "monthly", "quarterly", "seasonal", "annual")
FAULT_TYPES = (
    "duplicate",
    "delayed",
    "malformed",
    "missing_field",
    "schema_drift",
    "stale",
    "out_of_order",
    "partial_curve",
)
FAILURE_CATEGORIES = (
    "schema_violation",
    "duplicate",
    "malformed",
    "stale",
    "out_of_order",
    "missing_required_field",
    "unknown",
)
REPLAY_SOURCES = ("bronze_s3", "databento_historical", "dlq")
PROVIDER_STATUSES = ("healthy", "degraded", "outage", "unknown")

# Provider symbol (trimmed, upper case) -> canonical instrument.
INSTRUMENT_ALIASES = {
    "TTF": "TTF",
    "TTF GAS": "TTF",
    "TTF_GAS": "TTF",
    "NBP": "NBP",
    "NBP GAS": "NBP",
    "TTF_POWER": "TTF_POWER",
    "TTFPOWER": "TTF_POWER",
    "EEX_POWER": "TTF_POWER",
    "BRENT": "BRENT",
    "BRN": "BRENT",
    "CO": "BRENT",
    "WTI": "WTI",
    "CL": "WTI",
    "EUA": "EU_ETS",
    "EU_ETS": "EU_ETS",
    "CO2": "EU_ETS",
}

# Canonical instrument -> (currency, unit).
INSTRUMENT_UNITS = {
    "TTF": ("EUR", "MWh"),
    "NBP": ("EUR", "MWh"),
    "TTF_POWER": ("EUR", "MWh"),
    "BRENT": ("USD", "bbl"),
    "WTI": ("USD", "bbl"),
    "EU_ETS": ("EUR", "tonne"),
}

# Canonical instrument -> tenors a complete serving curve holds.
SERVING_EXPECTED_TENORS = {
    "TTF": 24,
    "NBP": 24,
    "BRENT": 24,
    "WTI": 24,
    "EU_ETS": 5,
    "TTF_POWER": 32,
}

# Validation score: hundredths taken off per occurrence of a fault.
VALIDATION_PENALTIES = {
    "duplicate": 30,
    "malformed": 50,
    "schema_drift": 20,
    "stale": 25,
    "out_of_order": 25,
    "delayed": 10,
    "missing_field": 40,
    "partial_curve": 15,
}

# Curve-event score: hundredths taken off once per distinct fault.
CURVE_PENALTIES = {
    "delayed": 5,
    "schema_drift": 20,
    "stale": 30,
    "partial_curve": 25,
    "out_of_order": 10,
}

# Vendor daily bars: instrument -> contract details.
VENDOR_CONTRACTS = {
    "BRENT": {
        "symbol": "BRN",
        "dataset": "GLBX.MDP3",
        "currency": "USD",
        "unit": "bbl",
        "curve_name": "BRENT_CRUDE_FORWARD",
    },
    "WTI": {
        "symbol": "CL",
        "dataset": "GLBX.MDP3",
        "currency": "USD",
        "unit": "bbl",
        "curve_name": "WTI_CRUDE_FORWARD",
    },
}

# Latency histogram bucket bounds, seconds.
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 30.0)

PRICE = T.DecimalType(20, 8)

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------


def _fields(*pairs: tuple[str, T.DataType | str]) -> T.StructType:
    schema = T.StructType()
    for name, kind in pairs:
        schema = schema.add(name, kind, True)
    return schema


# ``arrival_seq`` breaks ties between rows received in the same instant; on a
# topic it is the broker's own position of the record.
RAW_EVENT = _fields(
    ("event_id", "string"),
    ("provider", "string"),
    ("instrument", "string"),
    ("received_at", "timestamp"),
    ("event_timestamp", "timestamp"),
    ("payload", "string"),
    ("injected_faults", T.ArrayType(T.StringType())),
    ("is_replay", "boolean"),
    ("replay_source", "string"),
    ("trace_id", "string"),
    ("arrival_seq", "long"),
)

CURVE_EVENT = _fields(
    ("event_id", "string"),
    ("source_event_id", "string"),
    ("curve_name", "string"),
    ("instrument", "string"),
    ("tenor", "string"),
    ("delivery_period", "string"),
    ("price", PRICE),
    ("currency", "string"),
    ("unit", "string"),
    ("provider", "string"),
    ("version", "long"),
    ("event_timestamp", "timestamp"),
    ("ingestion_timestamp", "timestamp"),
    ("quality_score", "double"),
    ("is_replay", "boolean"),
    ("replay_source", "string"),
    ("trace_id", "string"),
    ("arrival_seq", "long"),
)

DLQ_EVENT = _fields(
    ("dlq_event_id", "string"),
    ("original_event_id", "string"),
    ("provider", "string"),
    ("instrument", "string"),
    ("failure_reason", "string"),
    ("failure_category", "string"),
    ("raw_payload", "string"),
    ("original_received_at", "timestamp"),
    ("dlq_timestamp", "timestamp"),
    ("retry_count", "integer"),
    ("trace_id", "string"),
)

SNAPSHOT = _fields(
    ("snapshot_id", "string"),
    ("curve_name", "string"),
    ("instrument", "string"),
    ("provider", "string"),
    ("as_of", "timestamp"),
    (
        "tenors",
        T.MapType(
            T.StringType(),
            _fields(
                ("price", PRICE),
                ("quality_score", "double"),
                ("last_updated", "timestamp"),
            ),
        ),
    ),
    ("completeness", "double"),
    ("is_authoritative", "boolean"),
    ("version", "long"),
)

ARRIVAL_ORDER = ("received_at", "arrival_seq")
