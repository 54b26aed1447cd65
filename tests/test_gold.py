from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

from builders import NOON, curves
from pyspark.sql import functions as F

from curvewright.operators import gold, serving


def assembled(spark, rows, **kw):
    return {r["window_start"]: r for r in gold.snapshots(curves(spark, rows), **kw).collect()}


def test_same_window_collapses_and_last_arrival_wins(spark):
    rows = [
        {"price": Decimal("1"), "provider": "first"},
        {"price": Decimal("2"), "event_timestamp": NOON + timedelta(seconds=90)},
        {"price": Decimal("3"), "event_timestamp": NOON + timedelta(seconds=30)},
        {"tenor": "2024-04", "event_timestamp": NOON + timedelta(seconds=299)},
        {"event_timestamp": NOON + timedelta(seconds=300)},
    ]
    got = assembled(spark, rows)
    assert len(got) == 2
    window = got[NOON]
    prices = {e["tenor"]: float(e["price"]) for e in window["entries"]}
    assert prices == {"2024-03": 3.0, "2024-04": 42.5}
    assert window["version"] == 4 and window["provider"] == "first"
    later = got[NOON + timedelta(minutes=5)]
    assert later["expected_tenors"] == 2 and later["completeness"] == 0.5


def test_curves_stay_apart(spark):
    rows = [{}, {"curve_name": "NBP_MONTHLY_FWD", "instrument": "NBP"}]
    assert gold.snapshots(curves(spark, rows)).count() == 2


def test_gate_and_authority(spark):
    one_of_ten = gold.snapshots(curves(spark, [{}]), expected_override=10)
    assert gold.gate(one_of_ten).count() == 0
    both = gold.snapshots(curves(spark, [{}, {"tenor": "2024-04"}]), expected_override=2).first()
    assert both["is_authoritative"] and both["completeness"] == 1.0
    poor = gold.snapshots(curves(spark, [{"quality_score": 0.5}])).first()
    assert not poor["is_authoritative"]
    edge = gold.snapshots(curves(spark, [{"quality_score": 0.7}])).first()
    assert edge["is_authoritative"]


def test_window_closes_two_widths_after_its_end(spark):
    windows = gold.window_rows(gold.tenor_prices(curves(spark, [{}])))
    for minutes, ready in ((14, 0), (15, 1)):
        as_of = F.lit(NOON + timedelta(minutes=minutes)).cast("timestamp")
        assert gold.closed_windows(windows, as_of, 300).count() == ready
        assert gold.pending_count(windows, as_of, 300).first()[0] == 1 - ready


def test_shape(spark):
    prices = {"2024-03": 10, "2024-04": 11, "2024-05": 12, "2024-06": 13, "2024-07": 100}
    rows = [
        {"tenor": t, "price": Decimal(p), "event_timestamp": NOON + timedelta(seconds=i * 60)}
        for i, (t, p) in enumerate(prices.items())
    ]
    snaps = gold.snapshots(curves(spark, rows))
    got = gold.snapshot_rows(gold.with_shape(snaps, stale_after_seconds=150)).first()
    assert got["front_price"] == 10.0 and got["curve_slope"] == 22.5
    assert got["num_tenors"] == 5 and got["outlier_tenors"] == 1 and got["stale_tenors"] == 2
    assert got["tenors"]["2024-07"]["price"] == Decimal("100.00000000")
    assert '"price":"10.00000000"' in got["tenors_json"]


def test_serving_snapshot_gate_and_history(spark):
    months = [f"2024-{m:02d}" for m in range(1, 13)] + [f"2025-{m:02d}" for m in range(1, 13)]
    rows = [{"tenor": t} for t in months]
    assert serving.snapshots(curves(spark, rows[:19])).count() == 0
    served = serving.snapshots(curves(spark, rows[:20])).first()
    assert served["tenor_count"] == 20 and served["version"] == 20
    history = serving.history(curves(spark, rows), rows=5)
    assert history.count() == 5


def test_history_of_one_instrument_in_one_hour(spark):
    """20,000 events of a second or two, many at one time, spread over 12 tasks."""
    events = spark.range(0, 20_000, 1, 12).select(
        F.when(F.col("id") % 100 > 0, "NBP").otherwise("TTF").alias("instrument"),
        F.hex(F.xxhash64("id")).alias("event_id"),
        F.timestamp_millis(F.pmod(F.xxhash64("id"), F.lit(1500)) + 1_700_000_000_000).alias("event_timestamp"),
    )
    newest = {}
    for r in events.withColumn("ms", F.unix_millis("event_timestamp")).collect():
        newest.setdefault(r["instrument"], []).append((r["ms"], r["event_id"]))
    want = {
        (name, *event, place)
        for name, found in newest.items()
        for place, event in enumerate(sorted(found, reverse=True)[:150], 1)
    }
    history = serving.history(events, rows=150)
    got = [(r["instrument"], r["event_timestamp_ms"], r["event_id"], r["rank"]) for r in history.collect()]
    assert len(got) == len(want) == 300 and set(got) == want
    # Tasks keep the wanted number of their own events before any are moved.
    plan = history._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4


def test_provider_status(spark):
    df = spark.createDataFrame([(0.0,), (299.9,), (300.0,), (900.0,), (None,)], "age double")
    got = [r[0] for r in df.select(serving.provider_status(F.col("age"))).collect()]
    assert got == ["healthy", "healthy", "degraded", "outage", "unknown"]
