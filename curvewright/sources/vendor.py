"""Vendor history (exported bars and trades) as raw market events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvewright.functions.payload import JSON_TEXT
from curvewright.schemas import VENDOR_CONTRACTS

SCALE = 1e-9


def _contract(field: str, instrument: Column) -> Column:
    entries = ", ".join(f"'{name}', '{spec[field]}'" for name, spec in VENDOR_CONTRACTS.items())
    return F.element_at(F.expr(f"map({entries})"), instrument)


def _nanos_to_time(nanos: Column) -> Column:
    # Whole numbers: nanoseconds since 1970 have no exact double. Rounds down, also before 1970.
    nanos = nanos.cast("bigint")
    return F.timestamp_micros(F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000)))


def bar_events(bars: DataFrame, provider: str = "databento") -> DataFrame:
    """Daily bars as raw events; bars without a closing price are dropped.

    ``bars``: instrument, ts_event (ns), open/high/low/close (1e-9 fixed point),
    volume, symbol.
    """
    def px(name: str) -> Column:
        return F.round(F.col(name) * F.lit(SCALE), 4)

    instrument = F.col("instrument")
    symbol = F.coalesce("symbol", _contract("symbol", instrument))
    payload = F.to_json(
        F.struct(
            px("close").alias("price"),
            px("open").alias("open"),
            px("high").alias("high"),
            px("low").alias("low"),
            px("close").alias("close"),
            F.col("volume").alias("volume"),
            F.when(symbol != "", symbol).otherwise("M+1").alias("tenor"),
            _contract("curve_name", instrument).alias("curve_name"),
            _contract("currency", instrument).alias("currency"),
            _contract("unit", instrument).alias("unit"),
            _contract("dataset", instrument).alias("dataset"),
            symbol.alias("raw_symbol"),
            F.lit("databento").alias("source"),
            F.lit("1.0").alias("schema_version"),
        ),
        JSON_TEXT,
    )
    event_time = _nanos_to_time(F.col("ts_event"))
    identity = F.concat_ws("|", F.lit("bar"), "instrument", "symbol", "ts_event", "arrival_seq")
    return bars.where(
        (F.col("close") != 0) & _contract("symbol", instrument).isNotNull()
    ).select(
        F.md5(identity).alias("event_id"),
        F.lit(provider).alias("provider"),
        "instrument",
        event_time.alias("received_at"),
        event_time.alias("event_timestamp"),
        payload.alias("payload"),
        F.array().cast("array<string>").alias("injected_faults"),
        F.lit(False).alias("is_replay"),
        F.lit(None).cast("string").alias("replay_source"),
        F.md5(F.concat(F.lit("trace|"), identity)).alias("trace_id"),
        "arrival_seq",
    )


def trade_events(
    trades: DataFrame,
    job_id: str,
    received_at: Column,
    provider: str | None = None,
    instrument: str | None = None,
    dataset: str = "GLBX.MDP3",
) -> DataFrame:
    """Vendor trade rows as replayed raw events; every field goes into the payload."""
    fields = [c for c in trades.columns if c != "arrival_seq"]
    named = F.coalesce(
        F.nullif(F.col("symbol").cast("string"), F.lit("")),
        F.nullif(F.col("instrument_id").cast("string"), F.lit("")),
        F.lit(instrument).cast("string"),
        F.lit("unknown"),
    )
    identity = F.concat_ws("|", F.lit(job_id), "arrival_seq")
    return trades.select(
        F.md5(identity).alias("event_id"),
        F.lit(provider or dataset).alias("provider"),
        named.alias("instrument"),
        received_at.alias("received_at"),
        _nanos_to_time(F.col("ts_event")).alias("event_timestamp"),
        F.to_json(F.struct(*fields), JSON_TEXT).alias("payload"),
        F.array().cast("array<string>").alias("injected_faults"),
        F.lit(True).alias("is_replay"),
        F.lit("databento_historical").alias("replay_source"),
        F.md5(F.concat(F.lit("trace|"), identity)).alias("trace_id"),
        "arrival_seq",
    )


def feed_union(primary: DataFrame, backup: DataFrame) -> DataFrame:
    """Real feed rows, and backup rows of the instruments the real feed lacks.

    Instruments form a short list, so the anti join's right side is a handful
    of rows after ``distinct``.
    """
    covered = primary.select("instrument").distinct()
    return primary.unionByName(backup.join(covered, "instrument", "left_anti"))
