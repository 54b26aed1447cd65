from __future__ import annotations

import random
from datetime import timedelta

import pytest
from builders import NOON, raw
from pyspark.sql import functions as F

from curvewright.functions.scores import curve_score, validation_score
from curvewright.operators import dedup, validate


def outcomes(spark, rows):
    found = validate.validate(raw(spark, rows)).collect()
    return {r["arrival_seq"]: r for r in found}


def price(text):
    return {"payload": '{"price":%s,"tenor":"2024-03"}' % text}


def test_required_fields_are_named_in_order(spark):
    got = outcomes(
        spark,
        [
            {"provider": ""},
            {"instrument": ""},
            {"event_id": "", "provider": ""},
            {"payload": "{}"},
            {"event_timestamp": None},
            {},
        ],
    )
    assert [got[i]["category"] for i in range(5)] == ["missing_required_field"] * 5
    assert got[0]["reason"] == "Missing required fields: provider"
    assert got[2]["reason"] == "Missing required fields: event_id, provider"
    assert got[3]["reason"] == "Missing required fields: payload"
    assert got[5]["outcome"] == "passed"


def test_price_types_and_bounds(spark):
    texts = ["-1", "0", "1", "500000", "1000000", "1500000", "null", '"42"', "true", "[1]", '"~~CORRUPTED~~"']
    got = outcomes(spark, [price(t) for t in texts] + [{"payload": '{"tenor":"2024-03"}'}, {"payload": "[1]"}])
    categories = [got[i]["category"] for i in range(len(texts) + 2)]
    assert categories == [
        "malformed",
        "malformed",
        None,
        None,
        "malformed",
        "malformed",
        None,
        "schema_violation",
        None,
        "schema_violation",
        "schema_violation",
        None,
        "schema_violation",
    ]
    assert got[0]["reason"] == "payload.price -1 must be > 0.0"
    assert got[7]["reason"] == "payload.price must be numeric, got str"
    assert got[12]["reason"] == "payload must be a dict, got list"


def test_time_bounds(spark):
    shifts = [
        timedelta(minutes=6),
        timedelta(hours=1),
        timedelta(minutes=4),
        timedelta(minutes=5),
        -timedelta(hours=25),
        -timedelta(days=2),
        -timedelta(hours=23),
        -timedelta(hours=24),
    ]
    got = outcomes(spark, [{"event_timestamp": NOON + s} for s in shifts])
    assert [got[i]["category"] for i in range(8)] == [
        "out_of_order",
        "out_of_order",
        None,
        None,
        "stale",
        "stale",
        None,
        None,
    ]
    assert got[4]["reason"] == "event_timestamp is 25.0h old, exceeds max age of 24h"


def test_first_failing_rule_wins_and_memory_of_ids(spark):
    late = {"event_timestamp": NOON - timedelta(days=3)}
    got = outcomes(
        spark,
        [
            {"event_id": "a", **price('"x"')},  # rejected before it is remembered
            {"event_id": "a", "received_at": NOON + timedelta(seconds=1)},
            {"event_id": "b", **late},  # rejected after it is remembered
            {"event_id": "b", "received_at": NOON + timedelta(seconds=1)},
            {"event_id": "c", **late, **price("-5")},
        ],
    )
    assert [got[i]["outcome"] for i in range(5)] == ["failed", "passed", "failed", "duplicate", "failed"]
    assert got[4]["category"] == "stale"


def test_routing_is_complete_and_disjoint(spark):
    rows = [{} for _ in range(70)] + [price("-1") for _ in range(30)]
    result = validate.validate(raw(spark, rows))
    assert validate.validated_events(result).count() == 70
    letters = validate.dead_letters(result)
    assert letters.count() == 30
    assert letters.where("get_json_object(raw_payload, '$.trace_id') = trace_id").count() == 30


def test_routing_conserves_rows(stages):
    counts = {r["outcome"]: r["n"] for r in stages.outcomes.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == stages.raw.count()


def brute_force_repeats(rows, ttl_ms):
    accepted, anchor = set(), {}
    for event_id, at, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        ms = int(at.timestamp() * 1000)
        if event_id not in anchor or ms >= anchor[event_id] + ttl_ms:
            anchor[event_id] = ms
            accepted.add(seq)
    return accepted


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_match_brute_force_with_a_hot_id(spark, seed):
    rng = random.Random(seed)
    rows = []
    for seq in range(4000):
        # A third of all rows share one id for longer than the time to live.
        event_id = "hot" if seq % 3 == 0 else f"id-{rng.randrange(400)}"
        at = NOON + timedelta(milliseconds=rng.randrange(0, 6 * 3600 * 1000))
        rows.append((event_id, at, seq))
    df = spark.createDataFrame(rows, "event_id string, received_at timestamp, arrival_seq long")
    got = {r["arrival_seq"] for r in dedup.accepted_arrivals(df, 3600).collect()}
    assert got == brute_force_repeats(rows, 3_600_000)


def test_repeat_does_not_extend_the_time_to_live(spark):
    at = [0, 3000, 3599, 3600, 7199, 7200]
    df = spark.createDataFrame(
        [("x", NOON + timedelta(seconds=s), i) for i, s in enumerate(at)],
        "event_id string, received_at timestamp, arrival_seq long",
    )
    got = {r["arrival_seq"] for r in dedup.accepted_arrivals(df, 3600).collect()}
    assert got == {0, 3, 5}


def scores(spark, expr, lists):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, f array<string>")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("f"))).collect()]


def test_validation_score_counts_every_occurrence(spark):
    got = scores(
        spark,
        validation_score,
        [[], ["malformed"], ["duplicate"], ["delayed", "delayed"], ["stale", "delayed"],
         ["duplicate", "malformed", "schema_drift", "stale"], ["missing_field"], ["partial_curve"]],
    )
    assert got == [1.0, 0.5, 0.7, 0.8, 0.65, 0.0, 0.6, 0.85]


def test_curve_score_counts_distinct_faults(spark):
    got = scores(
        spark,
        curve_score,
        [[], ["delayed"], ["schema_drift"], ["stale"], ["partial_curve"], ["out_of_order"],
         ["stale", "stale"], ["stale", "delayed"], ["malformed"], ["duplicate"]],
    )
    assert got == [1.0, 0.95, 0.8, 0.7, 0.75, 0.9, 0.7, 0.65, 1.0, 1.0]


def fold(values, window):
    total = count = 0.0
    out = []
    for v in values:
        total, count = total + v, count + 1
        if count >= window:
            total, count = total / 2, count / 2
        out.append(total / count)
    return out


@pytest.mark.parametrize("window", [10, 7, 100])
def test_rolling_average_matches_the_fold_and_carries_over(spark, window):
    rng = random.Random(window)
    faults = [rng.choice([[], ["malformed"], ["delayed"], ["stale", "delayed"]]) for _ in range(500)]
    rows = [
        {
            "provider": "a" if i % 3 else "b",
            "injected_faults": f,
            "received_at": NOON + timedelta(minutes=7 * i),
        }
        for i, f in enumerate(faults)
    ]
    scored = raw(spark, rows).withColumn("quality_score", validation_score(F.col("injected_faults")))
    whole = validate.rolling_scores(scored, window, block=128).collect()
    first = validate.rolling_scores(scored.where("arrival_seq < 333"), window)
    rest = validate.rolling_scores(
        scored.where("arrival_seq >= 333"), window, start=validate.rolling_carry(first)
    ).collect()
    for provider in ("a", "b"):
        mine = sorted((r for r in whole if r["provider"] == provider), key=lambda r: r["arrival_seq"])
        expected = fold([r["quality_score"] for r in mine], window)
        assert [r["rolling_average"] for r in mine] == pytest.approx(expected, abs=1e-12)
        by_seq = dict(zip((r["arrival_seq"] for r in mine), expected))
        for r in rest:
            if r["provider"] == provider:
                assert r["rolling_average"] == pytest.approx(by_seq[r["arrival_seq"]], abs=1e-12)


def test_of_equal_messages_one_passes(spark, tmp_path):
    import json

    from curvewright.sources import topics

    message = {
        "event_id": "same", "provider": "p", "instrument": "TTF", "received_at": "2024-03-01T12:00:00Z",
        "event_timestamp": "2024-03-01T12:00:00Z", "payload": {"price": 42.5, "tenor": "2024-03"},
    }
    folder = tmp_path / "raw"
    folder.mkdir()
    other = json.dumps(message | {"event_id": "other"})
    (folder / "part.json").write_text("\n".join([json.dumps(message)] * 3 + [other]) + "\n")
    read = topics.read_topic(spark, "raw", directory=str(tmp_path), stream=False)
    outcomes = validate.validate(topics.decode(read)[0])
    counts = {(r["event_id"], r["outcome"]): r["count"] for r in outcomes.groupBy("event_id", "outcome").count().collect()}
    assert counts == {("same", "passed"): 1, ("same", "duplicate"): 2, ("other", "passed"): 1}


def test_equal_positions_with_different_content_accept_one(spark):
    rows = [{"event_id": "x", "arrival_seq": 7, "trace_id": t} for t in ("a", "b", "b")]
    rows += [{"event_id": "", "arrival_seq": 7}] * 2 + [{"event_id": "y"}]
    got = validate.validate(raw(spark, rows)).groupBy("event_id", "outcome").count().collect()
    assert {tuple(r) for r in got} == {("x", "passed", 1), ("x", "duplicate", 2), ("", "failed", 2), ("y", "passed", 1)}


def test_a_silent_provider_is_out_until_now(spark):
    from curvewright.operators import alerts

    events = raw(spark, [{"provider": "a"}, {"provider": "b", "received_at": NOON + timedelta(minutes=59)}])
    got = alerts.provider_outage(events, F.lit(NOON + timedelta(hours=1))).collect()
    assert [(r["provider"], r["ends_at"], r["gap_seconds"]) for r in got] == [("a", None, 3600.0)]


def test_vendor_times_keep_every_microsecond(spark):
    from curvewright.sources import vendor

    micros = [1_700_000_000_000_001 + 7 * i for i in range(2000)] + [-1, -999_999]
    frame = spark.createDataFrame([(m * 1000 + m % 1000,) for m in micros], "n long")
    got = [r[0] for r in frame.select(F.unix_micros(vendor._nanos_to_time(F.col("n")))).collect()]
    assert got == micros
