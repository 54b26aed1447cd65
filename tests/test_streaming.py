from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from curvewright.operators import serving
from curvewright.schemas import CURVE_EVENT, RAW_EVENT
from curvewright.sources import bronze, upserts
from curvewright.streaming import jobs
from curvewright.streaming.serving import ServingTables, serving_job
from curvewright.streaming.state import data_driven, decide, flag_repeats_keyed

DAY = 86_400


def source(spark, folder):
    return spark.readStream.schema(RAW_EVENT).option("maxFilesPerTrigger", 1).parquet(folder)


def write_days(raw, folder, low, high):
    raw.where(F.dayofmonth("received_at").between(low, high)).coalesce(1).write.mode("append").parquet(folder)


def test_streams_equal_the_batch_across_a_restart(spark, stages, tmp_path):
    root, folder = str(tmp_path / "run"), str(tmp_path / "in")
    # The first run sees half of the data, the second resumes from its checkpoints.
    write_days(stages.raw, folder, 1, 15)
    jobs.run_available(source(spark, folder), root, DAY)
    write_days(stages.raw, folder, 16, 31)
    jobs.run_available(source(spark, folder), root, DAY)

    outcomes = spark.read.parquet(f"{root}/outcomes").select("arrival_seq", "outcome", "category")
    batch = stages.outcomes.select("arrival_seq", "outcome", "category")
    assert outcomes.exceptAll(batch).count() == 0 and outcomes.count() == batch.count()

    curves = spark.read.parquet(f"{root}/curves").select("event_id", "version")
    wanted = stages.curves.select("event_id", "version")
    assert curves.exceptAll(wanted).count() == 0 and curves.count() == wanted.count()
    assert spark.read.parquet(f"{root}/silver").count() == wanted.count()

    columns = ["curve_name", "as_of", "num_tenors", "version", "completeness"]
    gold = upserts.gold_table(spark, f"{root}/gold").read().select(*columns)
    closed = stages.gold.select(*columns).where(F.col("as_of") <= gold.agg(F.max("as_of")).first()[0])
    assert gold.count() > 0
    assert gold.exceptAll(closed).count() == 0 and closed.exceptAll(gold).count() == 0


def test_bronze_stream_keeps_every_row(spark, stages, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "bronze")
    write_days(stages.raw.where("provider <> ''"), folder, 1, 2)
    query = bronze.stream_bronze(source(spark, folder), root, str(tmp_path / "ck"), every=None)
    query.awaitTermination()
    assert bronze.read_bronze(spark, root).count() == spark.read.parquet(folder).count()


def test_no_row_is_lost_late_empty_or_copied(spark, tmp_path):
    import json
    from datetime import timedelta

    from builders import NOON

    from curvewright.sources import topics

    folder, root = tmp_path / "raw", str(tmp_path / "run")
    folder.mkdir()

    def message(event_id, at):
        stamp = at.strftime("%Y-%m-%dT%H:%M:%SZ")
        body = {"event_id": event_id, "provider": "p", "instrument": "TTF", "received_at": stamp}
        return json.dumps(body | {"event_timestamp": stamp, "payload": {"price": 42.5, "tenor": "2024-03"}})

    late = NOON - timedelta(days=5)
    batches = [
        [message("a", NOON)] * 40 + [message("", NOON)] * 60 + ["{broken", "[]"],
        [message("b", NOON + timedelta(days=2)), message("a", NOON + timedelta(minutes=59))],
        [message("c", late), message("c", late), message("a", late), message("a", NOON + timedelta(hours=1))],
    ]
    for number, lines in enumerate(batches):
        (folder / f"part-{number}.json").write_text("\n".join(lines) + "\n")
        stream = topics.read_topic(spark, "raw", directory=str(tmp_path), stream=True)
        jobs.intake_job(stream, root, forget_seconds=10 * DAY).awaitTermination()
    outcomes = spark.read.parquet(f"{root}/outcomes")
    got = {(r["event_id"], r["outcome"]): r["count"] for r in outcomes.groupBy("event_id", "outcome").count().collect()}
    assert got == {
        ("a", "passed"): 2, ("a", "duplicate"): 41, ("", "failed"): 60, ("b", "passed"): 1,
        ("c", "passed"): 1, ("c", "duplicate"): 1,
    }
    letters = spark.read.parquet(f"{root}/dlq")
    assert letters.count() == 62 and outcomes.count() + 2 == sum(map(len, batches))


def test_a_repeated_epoch_writes_nothing_new(spark, tmp_path):
    rows = spark.range(5)
    first = sorted(jobs._epoch_write(rows, str(tmp_path), 3).inputFiles())
    assert sorted(jobs._epoch_write(rows, str(tmp_path), 3).inputFiles()) == first


def test_a_partly_written_epoch_is_written_anew(spark, tmp_path):
    jobs._epoch_write(spark.range(2), str(tmp_path), 4)
    os.remove(tmp_path / "epoch=4" / "_SUCCESS")  # what a job that died while moving files leaves
    assert jobs._epoch_write(spark.range(5), str(tmp_path), 4).count() == 5


@pytest.mark.parametrize("seed", range(5))
def test_decisions_are_those_of_one_by_one(seed):
    rng, ttl = random.Random(seed), 60_000
    anchor, seen = None, None
    for _ in range(6):  # micro-batches, with rows that come late
        places = [(rng.randrange(0, 400_000_000), n, 0) for n in range(rng.randrange(1, 30))]
        got, after = decide(places, anchor, ttl)
        want = [True] * len(places)
        for i in sorted(range(len(places)), key=places.__getitem__):
            ms = places[i][0] // 1000
            if seen is None or ms >= seen + ttl:
                want[i], seen = False, ms
        assert got == want and after == seen
        anchor = after


SMALL = "event_id string, received_at timestamp, arrival_seq long, note string"


def keyed_stream(spark, folder, root, **options):
    stream = spark.readStream.schema(SMALL).option("maxFilesPerTrigger", 1).parquet(folder)
    flagged = flag_repeats_keyed(stream, F.col("note") != "unsound", **options)
    writer = flagged.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
    with data_driven(spark):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def at(second):
    from datetime import timedelta

    from builders import NOON

    return NOON + timedelta(seconds=second)


def test_keyed_repeats_over_restarts_late_rows_and_bystanders(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "run")
    batches = [
        [("a", at(0), 1, "x"), ("a", at(10), 2, "x"), ("b", at(0), 3, "unsound"), (None, at(0), 4, "x"), ("c", None, 5, "x")],
        [("a", at(59), 6, "x"), ("b", at(1), 7, "x"), ("a", at(-9000), 8, "late"), ("a", at(0), 1, "x")],
        [("a", at(60), 9, "x"), ("a", at(130), 10, "x"), ("a", at(119), 11, "x"), ("b", at(60), 12, "x")],
    ]
    for rows in batches:  # every run is a restart from the checkpoint
        spark.createDataFrame(rows, SMALL).coalesce(1).write.mode("append").parquet(folder)
        keyed_stream(spark, folder, root, ttl_seconds=60)
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == sum(map(len, batches))
    accepted = {(r["event_id"], r["arrival_seq"]) for r in got.where("not is_repeat").collect()}
    assert accepted == {("a", 1), ("b", 3), (None, 4), ("c", 5), ("b", 7), ("a", 9), ("a", 10)}


def test_a_hot_id_meets_its_anchor_once_a_millisecond(spark, tmp_path, monkeypatch):
    from curvewright.streaming import state

    monkeypatch.setattr(state, "HELD_BYTES", 2_000)  # spill
    folder, root = str(tmp_path / "in"), str(tmp_path / "run")
    hot = spark.range(20_000).selectExpr(
        "'hot' as event_id", "timestamp_millis(1709290800000 + id % 300) as received_at", "id as arrival_seq", "'x' as note"
    )
    cold = spark.range(500).selectExpr(
        "concat('e', id) as event_id", "timestamp_millis(1709290800000 + id) as received_at", "id + 100000 as arrival_seq",
        "'x' as note",
    )
    hot.union(cold).coalesce(2).write.parquet(folder)
    keyed_stream(spark, folder, root)
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == 20_500
    assert got.where("event_id = 'hot' and not is_repeat").select("arrival_seq").collect()[0][0] == 0
    assert got.where("not is_repeat").count() == 501


def test_state_written_follows_the_batch_not_the_history(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "run")

    def deltas():
        found = {}
        for top, _, names in os.walk(f"{root}/ck/state"):
            for name in names:
                if name.endswith((".changelog", ".delta")):
                    version = int(name.split(".")[0].split("_")[0])
                    found[version] = found.get(version, 0) + os.path.getsize(os.path.join(top, name))
        return found

    for number in range(8):
        size = 4000 if number == 0 else 40
        spark.range(size).selectExpr(
            f"concat('n{number}-', id) as event_id", "timestamp_millis(1709290800000 + id) as received_at",
            "id as arrival_seq", "'x' as note",
        ).coalesce(1).write.mode("append").parquet(folder)
        keyed_stream(spark, folder, root)
    sizes = deltas()
    assert len(sizes) == 8
    assert max(v for k, v in sizes.items() if k > 1) < sizes[1] / 5


def test_served_tables_equal_the_batch_after_a_restart(spark, stages, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "run")
    curves = stages.curves.persist()
    day = F.dayofmonth("ingestion_timestamp")
    tables = ServingTables(spark, root, history_rows=30, retention_seconds=3 * DAY, compact_after=3)
    late = (F.col("arrival_seq") % 50 == 4) & (day <= 15)
    for low, high in ((1, 7), (8, 15), (16, 23), (24, 31)):
        part = day.between(low, high) & ~late
        curves.where(part if high < 31 else part | late).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(CURVE_EVENT).option("maxFilesPerTrigger", 1).parquet(folder)
        serving_job(stream, tables, f"{root}/ck").awaitTermination()
    assert curves.where(late).count() > 5

    def same(got, want):
        got, want = got.select(*want.columns), want
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0

    plain = ["instrument", "tenor", "price", "quality_score", "last_updated"]
    same(tables.latest(), serving.latest_prices(curves).select(*plain))
    same(tables.history(), serving.history(curves, 30).select("instrument", "event_id", "event_timestamp_ms", "rank"))
    snapshot = ["instrument", "curve_name", "provider", "as_of", "version", "tenor_count", "completeness"]
    same(tables.snapshots(0.2), serving.snapshots(curves, 0.2).select(*snapshot))
    same(tables.health(stages.as_of), serving.provider_health(curves, stages.as_of))
    same(tables.minute_counts(stages.as_of), serving.minute_counts(curves, stages.as_of, 3 * DAY))
    assert tables.stale_instruments(stages.as_of, 0).count() == serving.stale_instruments(curves, stages.as_of, 0).count()
    # Repeating the last epoch changes nothing.
    before = tables.activity_log.read().agg(F.sum("events")).first()[0]
    tables.update(curves.limit(10), tables.activity_log.manifest()["epoch"])
    assert tables.activity_log.read().agg(F.sum("events")).first()[0] == before
    curves.unpersist()
