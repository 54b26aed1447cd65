"""Alerts held live against the batch form."""

from __future__ import annotations

import random
from datetime import timedelta

from builders import NOON
from pyspark.sql import functions as F

from curvewright.operators import alerts
from curvewright.streaming.alert_hold import held_stream

SCHEMA = "provider string, eval_time timestamp, firing boolean"


def test_streamed_alerts_are_the_stretches_of_the_batch(spark, tmp_path):
    rng = random.Random(8)
    folder, root = str(tmp_path / "in"), str(tmp_path / "run")
    # Runs of firing and quiet evaluations; some times are missing.
    rows = []
    for provider in "abc":
        firing = False
        for minute in range(120):
            firing = firing if rng.random() < 0.8 else not firing
            if rng.random() < 0.95:
                rows.append((provider, NOON + timedelta(minutes=minute), firing))
    # The last evaluation of all moves the watermark past every other.
    end = [("z", NOON + timedelta(minutes=300), False), ("z", NOON + timedelta(minutes=301), False)]
    rows.sort(key=lambda r: r[1])
    parts = [rows[:120], rows[120:200], rows[200:], end]
    # Neighbours change places across micro-batches.
    parts[0][-5:], parts[1][:5] = parts[1][:5], parts[0][-5:]
    for part in parts:
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        made = held_stream(stream, ["provider"], 60, 180, late_seconds=600)
        query = (
            made.writeStream.format("parquet").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    got = spark.read.parquet(f"{root}/out")
    want = alerts.held(spark.createDataFrame(rows, SCHEMA), ["provider"], 60, 180)
    columns = ["provider", "pending_from", "starts_at", "ends_at", "evaluations"]
    resolved = sorted(map(tuple, got.where("status = 'resolved'").select(*columns).collect()))
    assert resolved == sorted(map(tuple, want.select(*columns).collect())) and len(resolved) >= 5
    fired = got.where("status = 'firing'")
    # Each fires once, before it resolves, as soon as it has held.
    assert sorted((r["provider"], r["starts_at"]) for r in fired.collect()) == sorted((r[0], r[2]) for r in resolved)
    assert fired.where(F.col("evaluations") > 4).count() == 0
