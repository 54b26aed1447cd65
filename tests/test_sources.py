from __future__ import annotations

import gzip
import os
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from builders import NOON, curves, raw
from pyspark.sql import functions as F

from curvewright.operators import gold, replay
from curvewright.sources import bronze, landing, topics, upserts, vendor
from curvewright.sources.tables import silver_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_round_trip_prunes_folders(spark, tmp_path):
    rows = [
        {"payload": '{"price":30.0}', "received_at": NOON.replace(hour=7)},
        {"payload": '{"price":"~~CORRUPTED~~"}', "received_at": NOON.replace(hour=7), "injected_faults": ["malformed"]},
        {"received_at": NOON.replace(hour=9, minute=30)},
        {"received_at": NOON.replace(hour=12), "provider": "other"},
    ]
    root = str(tmp_path / "bronze")
    bronze.write_bronze(raw(spark, rows), root)
    back = bronze.read_bronze(spark, root)
    assert {(r["provider"], r["dt"], r["hh"]) for r in back.select("provider", "dt", "hh").distinct().collect()} == {
        ("p", "2024-03-01", "07"),
        ("p", "2024-03-01", "09"),
        ("other", "2024-03-01", "12"),
    }
    # A start inside the hour still reads that hour's folder.
    start = datetime(2024, 3, 1, 9, 45, tzinfo=timezone.utc)
    scanned = bronze.scan_bronze(back, "p", start, start + timedelta(hours=2))
    assert [r["arrival_seq"] for r in scanned.collect()] == [2]
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    scanned = bronze.scan_bronze(back, "p", start, start + timedelta(hours=2))
    filters = plan_of(scanned).split("PartitionFilters: ")[1].split("]")[0]
    assert "provider" in filters and "dt" in filters and "hh" in filters
    again = bronze.reinflate(back).where("arrival_seq = 1").first()
    assert again["injected_faults"] == ["malformed"] and "CORRUPTED" in again["payload"]


def test_replay_bronze_is_repeatable_and_bounded(spark):
    late = {"received_at": NOON + timedelta(hours=5), "event_timestamp": NOON}
    rows = [{}, late, {"event_timestamp": NOON + timedelta(hours=3)}, {"event_timestamp": None}, {"provider": "q"}]
    stored = bronze.bronze_rows(raw(spark, rows))
    window = (NOON.replace(tzinfo=timezone.utc), (NOON + timedelta(hours=1)).replace(tzinfo=timezone.utc))

    def run():
        return replay.replay_bronze(stored, "job", "p", *window, F.lit(NOON)).orderBy("arrival_seq").collect()

    first, second = run(), run()
    assert [r["arrival_seq"] for r in first] == [0, 1, 3]
    assert [r["event_id"] for r in first] == [r["event_id"] for r in second]
    assert all(r["is_replay"] and r["replay_source"] == "bronze_s3" for r in first)
    with pytest.raises(ValueError):
        replay.check_request(NOON, NOON, "dlq", None)
    with pytest.raises(ValueError):
        replay.check_request(NOON, NOON + timedelta(1), "bronze_s3", "")


def test_decode_splits_broken_messages(spark):
    good = '{"provider":"p","instrument":"TTF","event_timestamp":"2024-03-01T10:00:00","payload":{"price":1}}'
    texts = [
        good,
        good.replace("10:00:00", "11:00:00+01:00"),
        good.replace('{"price":1}', "5"),
        good.replace('"provider":"p",', ""),
        good.replace("2024-03-01T10:00:00", "soon"),
        good[:30],
        "",
        good.replace('"payload"', '"injected_faults":["gremlin"],"payload"'),
    ]
    df = spark.createDataFrame(
        [(t, NOON, i) for i, t in enumerate(texts)], "value string, received_at timestamp, arrival_seq long"
    )
    events, broken = topics.decode(df)
    kept = events.orderBy("arrival_seq").collect()
    assert [r["arrival_seq"] for r in kept] == [0, 1]
    assert kept[0]["event_timestamp"] == kept[1]["event_timestamp"] == datetime(2024, 3, 1, 10)
    assert kept[0]["event_id"] and kept[0]["received_at"] == NOON and kept[0]["payload"] == '{"price":1}'
    assert {r["arrival_seq"] for r in broken.collect()} == {2, 3, 4, 5, 6, 7}


def test_messages_carry_keys_and_headers(spark):
    row = topics.raw_messages(raw(spark, [{"injected_faults": ["stale"]}])).first()
    headers = {h["key"]: bytes(h["value"]).decode() for h in row["headers"]}
    assert row["key"] == "TTF" and headers == {"trace_id": "tr-0", "provider": "p", "has_faults": "true"}


def test_silver_load_is_idempotent(spark, tmp_path):
    path, stage = str(tmp_path / "silver"), str(tmp_path / "stage")
    rows = silver_rows(curves(spark, [{"event_id": f"e{i % 4}"} for i in range(8)]))
    upserts.load_silver(rows, path, stage + "1")
    upserts.load_silver(rows, path, stage + "2")
    upserts.load_silver(silver_rows(curves(spark, [{"event_id": "new"}])), path, stage + "3")
    assert sorted(r[0] for r in spark.read.parquet(path).select("event_id").collect()) == ["e0", "e1", "e2", "e3", "new"]


def test_gold_merge_updates_and_keeps_other_days(spark, tmp_path):
    def rows(prices):
        made = [
            {"price": Decimal(p), "event_timestamp": NOON + timedelta(days=d)} for d, p in prices.items()
        ]
        return gold.gold_table(curves(spark, made))

    path = str(tmp_path / "gold")
    assert upserts.merge_gold(rows({0: 1, 1: 2}), path, 0) == {"inserted": 2, "updated": 0}
    assert upserts.merge_gold(rows({1: 5, 2: 6}), path, 1) == {"inserted": 1, "updated": 1}
    assert upserts.merge_gold(rows({1: 9, 4: 6}), path, 1) == {"inserted": 0, "updated": 0}
    got = [r[0] for r in upserts.gold_table(spark, path).read().orderBy("as_of").select("front_price").collect()]
    assert got == [1.0, 5.0, 6.0]


def test_landing_arrays_and_null_texts(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    body = '[{"dlq_event_id":"1","provider":"NULL","retry_count":"x"},\n {"dlq_event_id":"2","provider":"","retry_count":3}]'
    with gzip.open(folder / "a.json.gz", "wt") as out:
        out.write(body)
    got = landing.dlq_pipe(landing.read_landing(spark, str(folder), array_files=True)).orderBy("dlq_event_id").collect()
    assert [(r["dlq_event_id"], r["provider"], r["retry_count"]) for r in got] == [("1", None, 0), ("2", None, 3)]


def test_vendor_bars_and_feed_union(spark):
    nanos = int(NOON.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000_000
    bars = spark.createDataFrame(
        [
            ("BRENT", nanos, None, 80_123_456_789, 1, 79_000_050_000, 5, "BRN", 0),
            ("WTI", nanos, 1, 1, 1, 0, 5, "CL", 1),
            ("WTI", nanos, 1, 1, 1, None, 5, "CL", 2),
            ("WTI", nanos, 1, 1, 1, 70_000_000_000, 5, "", 3),
        ],
        "instrument string, ts_event long, open long, high long, low long, close long, volume long, symbol string, arrival_seq long",
    )
    got = vendor.bar_events(bars).orderBy("arrival_seq").collect()
    assert [r["arrival_seq"] for r in got] == [0, 3]
    assert '"price":79.0001' in got[0]["payload"] and '"open":null' in got[0]["payload"]
    assert '"tenor":"M+1"' in got[1]["payload"] and got[0]["event_timestamp"] == NOON
    primary = raw(spark, [{"instrument": "TTF"}])
    backup = raw(spark, [{"instrument": "TTF"}, {"instrument": "NBP"}])
    assert sorted(r["instrument"] for r in vendor.feed_union(primary, backup).collect()) == ["NBP", "TTF"]


def bronze_feed(spark, hours, provider="p", n=4, shift=0):
    return raw(spark, [
        {"provider": provider, "arrival_seq": shift + 100 * h + i, "received_at": NOON + timedelta(hours=h, seconds=i),
         "event_timestamp": NOON + timedelta(hours=h, seconds=i - 7200)}
        for h in hours for i in range(n)
    ])


def seqs(rows):
    return sorted(r["arrival_seq"] for r in rows.collect())


def test_manifest_names_every_file_and_what_is_in_it(spark, tmp_path):
    root = str(tmp_path / "bronze")
    assert bronze.manifest(spark, root).count() == 0
    bronze.write_bronze(bronze_feed(spark, [0, 1]), root)
    bronze.write_bronze(bronze_feed(spark, [1], "a b/c%d", shift=1000), root)
    entries = bronze.manifest(spark, root).orderBy("provider", "hh").collect()
    assert [(r["provider"], r["hh"], r["rows"]) for r in entries] == [("a b/c%d", "13", 4), ("p", "12", 4), ("p", "13", 4)]
    for r in entries:
        assert os.path.getsize(f"{root}/{r['path']}") == r["bytes"]
    assert entries[1]["first_event"] == NOON - timedelta(hours=2)
    assert entries[1]["last_event"] == NOON - timedelta(hours=2) + timedelta(seconds=3)
    assert seqs(bronze.read_bronze(spark, root)) == seqs(bronze.read_files(spark, root, [r["path"] for r in entries]))


def test_manifest_scan_opens_only_files_that_can_match(spark, tmp_path):
    root = str(tmp_path / "bronze")
    bronze.write_bronze(bronze_feed(spark, range(5)), root)
    start = NOON + timedelta(hours=1, minutes=30)
    scanned = bronze.scan_manifest(spark, root, "p", start, start + timedelta(hours=2))
    whole = bronze.scan_bronze(bronze.read_bronze(spark, root), "p", start, start + timedelta(hours=2))
    assert seqs(scanned) == seqs(whole) and len(scanned.inputFiles()) == 3
    events = (NOON - timedelta(minutes=30), NOON)
    assert len(bronze.scan_manifest(spark, root, "p", NOON, NOON + timedelta(hours=9), events).inputFiles()) == 1
    assert bronze.scan_manifest(spark, root, "nobody", NOON, NOON).count() == 0


def test_gap_check_opens_no_data_file(spark, tmp_path):
    root = str(tmp_path / "bronze")
    bronze.write_bronze(bronze_feed(spark, [0, 1, 3]), root)
    for top, _, found in os.walk(f"{root}/provider=p"):
        for name in found:  # what cannot be read is not read
            open(os.path.join(top, name), "wb").write(b"broken")
    hours = replay.partition_hours(bronze.manifest(spark, root))
    first, last = (hours.agg(end("hour")).scalar() for end in (F.min, F.max))
    assert [(r["provider"], r["hour"]) for r in replay.bronze_gaps(hours, hours, first, last).collect()] == [
        ("p", NOON + timedelta(hours=2))
    ]


def test_the_driver_moves_new_folders_whole(spark, tmp_path, monkeypatch):
    from curvewright.sources import files

    calls, at = [], files._at
    monkeypatch.setattr(files, "_at", lambda *a: calls.append(a) or at(*a))
    for hours in (2, 20):
        calls.append(None)
        bronze.write_bronze(bronze_feed(spark, range(hours)), str(tmp_path / f"b{hours}"))
    few = calls.index(None, 1)
    assert len(calls) - few <= few + 4  # a further day folder at most, not one call a file
    root = str(tmp_path / "b20")
    bronze.write_bronze(bronze_feed(spark, [3, 30], shift=9000), root)  # hours there and new ones
    entries = bronze.manifest(spark, root).collect()
    assert len(entries) == 22 and all(os.path.getsize(f"{root}/{r['path']}") == r["bytes"] for r in entries)
    assert bronze.read_bronze(spark, root).count() == 88 and not os.listdir(f"{root}/_incoming")


def test_a_repeated_or_broken_epoch_leaves_its_rows_once(spark, tmp_path, monkeypatch):
    from curvewright.sources.log_table import LogTable

    root = str(tmp_path / "bronze")
    with monkeypatch.context() as patched:  # the driver dies after the files are in place
        patched.setattr(LogTable, "append", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            bronze.write_bronze(bronze_feed(spark, [0, 1]), root, 0)
    assert bronze.manifest(spark, root).count() == 0
    for _ in range(2):
        bronze.write_bronze(bronze_feed(spark, [0, 1]), root, 0)
    assert bronze.read_bronze(spark, root).count() == 8 and bronze.manifest(spark, root).count() == 2


def test_compaction_joins_the_small_files_of_closed_hours(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for epoch in range(4):
        bronze.write_bronze(bronze_feed(spark, [0, 1], shift=10 * epoch), root, epoch)
    before = seqs(bronze.read_bronze(spark, root))
    assert bronze.compact_bronze(spark, root, NOON + timedelta(hours=1)) == 1
    files_of = {r["hh"]: r["n"] for r in bronze.manifest(spark, root).groupBy("hh").agg(F.count("*").alias("n")).collect()}
    assert files_of == {"12": 1, "13": 4} and seqs(bronze.read_bronze(spark, root)) == before
    assert bronze.compact_bronze(spark, root, NOON + timedelta(hours=1)) == 0
    bronze.write_bronze(bronze_feed(spark, [0], shift=10_000), root, 3)  # an old epoch again
    assert seqs(bronze.read_bronze(spark, root)) == before
