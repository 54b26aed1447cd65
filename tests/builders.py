"""Small input tables."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from curvewright.schemas import CURVE_EVENT, RAW_EVENT

NOON = datetime(2024, 3, 1, 12, 0, 0)


def raw(spark, rows):
    """Raw events from partial dicts."""
    full = []
    for i, row in enumerate(rows):
        base = {
            "event_id": f"id-{i}",
            "provider": "p",
            "instrument": "TTF",
            "received_at": NOON,
            "event_timestamp": NOON,
            "payload": '{"price":42.5,"tenor":"2024-03"}',
            "injected_faults": [],
            "is_replay": False,
            "replay_source": None,
            "trace_id": f"tr-{i}",
            "arrival_seq": i,
        }
        base.update(row)
        full.append(tuple(base[f] for f in RAW_EVENT.fieldNames()))
    return spark.createDataFrame(full, RAW_EVENT)


def curves(spark, rows):
    full = []
    for i, row in enumerate(rows):
        base = {f: None for f in CURVE_EVENT.fieldNames()}
        base.update(
            event_id=f"c-{i}",
            curve_name="TTF_MONTHLY_FWD",
            instrument="TTF",
            tenor="2024-03",
            delivery_period="monthly",
            price=Decimal("42.5"),
            provider="p",
            version=i + 1,
            event_timestamp=NOON,
            ingestion_timestamp=NOON + timedelta(seconds=i),
            quality_score=1.0,
            is_replay=False,
            arrival_seq=i,
        )
        base.update(row)
        full.append(tuple(base[f] for f in CURVE_EVENT.fieldNames()))
    return spark.createDataFrame(full, CURVE_EVENT)
