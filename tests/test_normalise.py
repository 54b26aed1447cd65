from __future__ import annotations

from datetime import datetime

import pytest
from builders import NOON, raw
from pyspark.sql import functions as F

from curvewright.functions.tenors import (
    canonical_tenor,
    delivery_period,
    delivery_start,
    tenor_shape,
    tenor_text,
)
from curvewright.operators import normalise, validate
from curvewright.schemas import INSTRUMENT_ALIASES

TENORS = {
    "2024-03": ("2024-03", "monthly"),
    "2024-3": ("2024-03", "monthly"),
    "MAR24": ("2024-03", "monthly"),
    "dec24": ("2024-12", "monthly"),
    "Mar-24": ("2024-03", "monthly"),
    "Jun-2025": ("2025-06", "monthly"),
    "March 2024": ("2024-03", "monthly"),
    "DECEMBER 2025": ("2025-12", "monthly"),
    "May 2024": ("2024-05", "monthly"),
    "M+1": ("2024-12", "monthly"),
    "m+2": ("2025-01", "monthly"),
    "M+14": ("2026-01", "monthly"),
    "  2024-06  ": ("2024-06", "monthly"),
    "\t2024-06\n": ("2024-06", "monthly"),
    "Q1-2024": ("2024-Q1", "quarterly"),
    "Q3 2025": ("2025-Q3", "quarterly"),
    "2024-Q2": ("2024-Q2", "quarterly"),
    "2024Q4": ("2024-Q4", "quarterly"),
    "Q+1": ("2025-Q1", "quarterly"),
    "q+5": ("2026-Q1", "quarterly"),
    "Summer 2024": ("2024-SUM", "seasonal"),
    "SUM24": ("2024-SUM", "seasonal"),
    "Winter   2025": ("2025-WIN", "seasonal"),
    "WIN25": ("2025-WIN", "seasonal"),
    "Cal-2024": ("2024-CAL", "annual"),
    "CAL24": ("2024-CAL", "annual"),
    "2024": ("2024-CAL", "annual"),
    "spot": ("spot", "spot"),
    "D+1": ("spot", "spot"),
}
REJECTED = [
    "GARBAGE", "", "2024-13", "2024-0", "Mar 2024", "Cal-24", "Q5-2024", "2024Q5", "2025-CAL",
    "M+", "M+x", "Q1--2024", "Summer2024", "Autumn 2024", "XYZ24", "20245", "2024-003", "None",
]


def test_tenor_forms(spark):
    texts = [*TENORS, *REJECTED]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.withColumn("x", tenor_text(F.col("t"))).withColumn("s", tenor_shape(F.col("x")))
    clock = F.lit(datetime(2024, 11, 15, 8, 0)).cast("timestamp")
    tenor = canonical_tenor(F.col("x"), F.col("s"), clock)
    got = {r[0]: (r[1], r[2]) for r in df.select("t", tenor, delivery_period(tenor)).collect()}
    for text, wanted in TENORS.items():
        assert got[text] == wanted, text
    for text in REJECTED:
        assert got[text][0] is None, text


def test_delivery_order(spark):
    tenors = ["2024-CAL", "2024-Q3", "2024-SUM", "2024-WIN", "2024-05", "spot"]
    df = spark.createDataFrame([(t,) for t in tenors], "t string")
    got = {r[0]: r[1] for r in df.select("t", delivery_start(F.col("t"))).collect()}
    assert got == {
        "2024-CAL": "2024-01",
        "2024-Q3": "2024-07",
        "2024-SUM": "2024-04",
        "2024-WIN": "2024-10",
        "2024-05": "2024-05",
        "spot": "0000-00",
    }


def test_aliases(spark):
    symbols = [*INSTRUMENT_ALIASES, " ttf gas ", "brn\n", "UNKNOWN", "", "TTF_CAL25"]
    df = spark.createDataFrame([(s,) for s in symbols], "s string")
    got = {r[0]: r[1] for r in df.select("s", normalise.canonical_instrument(F.col("s"))).collect()}
    for alias, name in INSTRUMENT_ALIASES.items():
        assert got[alias] == name
    assert got[" ttf gas "] == "TTF" and got["brn\n"] == "BRENT"
    assert got["UNKNOWN"] is None and got[""] is None and got["TTF_CAL25"] is None


@pytest.mark.parametrize(
    "row, reason",
    [
        ({}, None),
        ({"instrument": "NOPE"}, "unknown_instrument"),
        ({"payload": '{"tenor":"2024-03"}'}, "missing_price"),
        ({"payload": '{"price":null,"tenor":"2024-03"}'}, "missing_price"),
        ({"payload": '{"price":true,"tenor":"2024-03"}'}, "invalid_price"),
        ({"payload": '{"price":1,"tenor":"GARBAGE"}'}, "unknown_tenor"),
        ({"payload": '{"price":1,"tenor":null}'}, "unknown_tenor"),
        ({"payload": '{"price":1}'}, "unknown_tenor"),
        ({"payload": '{"price":1,"tenor":2024}'}, None),
    ],
)
def test_rejections(spark, row, reason):
    events = validate.validated_events(validate.validate(raw(spark, [row])))
    assert normalise.interpret(events).first()["reject_reason"] == reason


def test_curve_event_fields_and_versions(spark):
    rows = [{"instrument": "NBP GAS", "payload": '{"price":%d,"tenor":"MAR24","currency":"GBP"}' % (i + 1)} for i in range(5)]
    events = validate.validated_events(validate.validate(raw(spark, rows)))
    got = normalise.normalise(events).orderBy("version").collect()
    assert [r["version"] for r in got] == [1, 2, 3, 4, 5]
    assert [float(r["price"]) for r in got] == [1, 2, 3, 4, 5]
    assert {(r["curve_name"], r["currency"], r["unit"], r["tenor"]) for r in got} == {
        ("NBP_MONTHLY_FWD", "EUR", "MWh", "2024-03")
    }
    assert got[0]["ingestion_timestamp"] == NOON
