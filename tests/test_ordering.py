from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from builders import NOON

from curvewright.operators.alerts import covered_times, held
from curvewright.operators.ordering import first_n, next_arrival, running_position
from curvewright.operators.quantiles import exact_quantiles, value_counts

SCHEMA = "k string, received_at timestamp, arrival_seq long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [
        ("hot" if i % 3 else f"k{i % 7}", NOON + timedelta(seconds=rng.randrange(200_000)), i)
        for i in range(3000)
    ]


def test_running_position(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["arrival_seq"]: r["n"] for r in running_position(df, ["k"], "n").collect()}
    seen: dict[str, int] = {}
    for key, _, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[key] = seen.get(key, 0) + 1
        assert got[seq] == seen[key]


def test_one_key_in_one_hour_is_many_tasks(spark):
    df = spark.range(40_000).selectExpr(
        "'hot' AS k", "timestamp_micros(1700000000000000 + id) AS received_at", "id AS arrival_seq"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        placed = running_position(df, ["k"], "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert placed.where("n != arrival_seq + 1").isEmpty()
    files = placed.inputFiles()
    sizes = [spark.read.parquet(f).count() for f in files]
    assert len(sizes) >= 3 and max(sizes) < 2 * 40_000 / len(sizes)


def test_first_n(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["arrival_seq"] for r in first_n(df, ["received_at", "arrival_seq"], 500).collect()}
    assert got == {r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))[:500]}


def test_next_arrival(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["k"], r["received_at"]): r["after"] for r in next_arrival(df, ["k"], "received_at", "after").collect()}
    for key in {r[0] for r in rows}:
        times = sorted({r[1] for r in rows if r[0] == key})
        for at, following in zip(times, [*times[1:], None]):
            assert got[(key, at)] == following


def test_exact_quantiles(spark):
    rng = random.Random(9)
    data = [("a" if i % 3 else "b", int(rng.expovariate(1e-5))) for i in range(5000)] + [("c", 4)]
    df = spark.createDataFrame(data, "k string, v long")
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    got = {r["k"]: r for r in exact_quantiles(value_counts(df, ["k"], "v"), ["k"], "v", wanted).collect()}
    for key in ("a", "b", "c"):
        values = [v for k, v in data if k == key]
        for label, q in wanted.items():
            assert got[key][label] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_hold_and_covered_times(spark):
    def at(minutes):
        return NOON + timedelta(minutes=minutes)

    firing = [(at(m), True) for m in (0, 1, 2, 3, 5, 6)] + [(at(4), False)]
    df = spark.createDataFrame([("p", t, f) for t, f in firing], "k string, eval_time timestamp, firing boolean")
    got = held(df, ["k"], 60, 180).collect()
    assert [(r["pending_from"], r["ends_at"], r["starts_at"]) for r in got] == [(at(0), at(3), at(3))]

    spans = spark.createDataFrame(
        [("x", at(0), at(9)), ("x", at(1), at(2)), ("x", at(5), at(10)), ("x", at(20), at(21))],
        "k string, starts_at timestamp, ends_at timestamp",
    )
    merged = covered_times(spans, ["k"]).orderBy("starts_at").collect()
    assert [(r["starts_at"], r["ends_at"]) for r in merged] == [(at(0), at(10)), (at(20), at(21))]
