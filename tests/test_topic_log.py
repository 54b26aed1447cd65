"""Topics without a broker: order, keys and headers, restarts, admission."""

from __future__ import annotations

import time

from builders import raw
from pyspark.sql import functions as F

from curvewright.sources import topic_log, topics
from curvewright.streaming import lag


def messages(spark, low, high, parts=1):
    rows = spark.range(low, high, numPartitions=parts)
    header = F.struct(F.lit("n").alias("key"), F.encode(F.col("id").cast("string"), "utf-8").alias("value"))
    return rows.select(
        F.concat(F.lit("k"), F.col("id") % 3).alias("key"), F.concat(F.lit("v\n\"é"), "id").alias("value"),
        F.array(header).alias("headers"),
    )


def numbers(rows):
    return [int(r["value"][4:]) for r in rows.orderBy("offset").collect()]


def test_order_keys_and_headers_survive(spark, tmp_path):
    root = str(tmp_path)
    topic_log.write_log(messages(spark, 0, 50), root, "t")
    topic_log.write_log(messages(spark, 50, 90, 3), root, "t")
    got = topic_log.read_log(spark, root, "t", stream=False)
    assert numbers(got) == list(range(90)) and [r["offset"] for r in got.orderBy("offset").collect()] == list(range(90))
    row = got.where("offset = 7").first()
    assert row["key"] == "k1" and row["headers"][0]["key"] == "n" and bytes(row["headers"][0]["value"]) == b"7"
    assert topic_log.read_log(spark, root, "nothing", stream=False).count() == 0
    # A real message, with a null key and without headers as well.
    topic_log.write_log(topics.raw_messages(raw(spark, [{"injected_faults": ["stale"]}])), root, "raw")
    kinds = "key string, value string, headers array<struct<key:string,value:binary>>"
    topic_log.write_log(spark.createDataFrame([(None, "x", None)], kinds), root, "raw")
    first, second = topic_log.read_log(spark, root, "raw", stream=False).orderBy("offset").collect()
    headers = {h["key"]: bytes(h["value"]).decode() for h in first["headers"]}
    assert first["key"] == "TTF" and headers == {"trace_id": "tr-0", "provider": "p", "has_faults": "true"}
    assert (second["key"], second["value"], second["headers"]) == (None, "x", [])


def test_a_named_batch_is_published_once_and_writers_share_a_topic(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        topic_log.write_log(messages(spark, 0, 5), root, "t", batch="epoch-3")
    assert numbers(topic_log.read_log(spark, root, "t", stream=False)) == list(range(5))
    log = topic_log.Log(root)
    stale = log.end("t")
    topic_log.write_log(messages(spark, 5, 8), root, "t")
    assert stale == 5 and log.end("t") == 8


def run(spark, root, out, seconds=None, **options):
    stream = topic_log.read_log(spark, root, "a,b", **options)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-ck")
    if seconds is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return []
    query = writer.trigger(processingTime="100 milliseconds").start()
    query.awaitTermination(seconds)
    query.stop()
    return [(p["timestamp"], p["numInputRows"]) for p in query.recentProgress]


def test_no_row_is_lost_or_doubled_by_restarts(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    for step in range(3):
        topic_log.write_log(messages(spark, 10 * step, 10 * step + 10, 2), root, "a")
        topic_log.write_log(messages(spark, 100 + step, 101 + step), root, "b")
        run(spark, root, out)
    got = spark.read.parquet(out)
    assert numbers(got.where("topic = 'a'")) == list(range(30))
    assert numbers(got.where("topic = 'b'")) == [100, 101, 102]


def test_admission_holds_the_rate_whatever_the_trigger(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    topic_log.write_log(messages(spark, 0, 500, 2), root, "a")
    topic_log.write_log(messages(spark, 0, 500, 2), root, "b")
    throttle = {"rows_per_second": 40, "plan": str(tmp_path / "plan.json")}
    began = time.monotonic()
    first = run(spark, root, out, 6, **throttle)
    elapsed = time.monotonic() - began
    done = spark.read.parquet(out).count()
    assert 0 < done <= 40 * (elapsed + 1) and max(n for _, n in first) <= 40
    run(spark, root, out, 4, **throttle)  # a restart goes on where the plan ended
    rows = spark.read.parquet(out)
    assert done < rows.count() <= 40 * (time.monotonic() - began + 2)
    assert rows.count() == rows.select("topic", "offset").distinct().count()
    for topic in ("a", "b"):
        offsets = sorted(r["offset"] for r in rows.where(F.col("topic") == topic).collect())
        assert offsets == list(range(len(offsets)))


def test_lag_is_the_number_of_unread_rows(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")

    def lags():
        return {r["topic"]: (r["position"], r["lag"]) for r in lag.log_lag(spark, root, "a,b", f"{out}-ck").collect()}

    topic_log.write_log(messages(spark, 0, 30), root, "a")
    topic_log.write_log(messages(spark, 0, 7), root, "b")
    assert lags() == {"a": (0, 30), "b": (0, 7)}
    run(spark, root, out)
    assert lags() == {"a": (30, 0), "b": (7, 0)}
    topic_log.write_log(messages(spark, 30, 42), root, "a")
    assert lags() == {"a": (30, 12), "b": (7, 0)}
    # A micro-batch that is planned and not finished has not been read.
    offsets = f"{out}-ck/offsets"
    with open(f"{offsets}/0") as first, open(f"{offsets}/1", "w") as planned:
        planned.write(first.read().replace('"a": 30', '"a": 42').replace('"a":30', '"a":42'))
    assert lags()["a"] == (30, 12)


def test_intake_reads_a_topic_log(spark, tmp_path):
    from curvewright.sources import topics as t
    from curvewright.streaming import jobs

    root, out = str(tmp_path / "log"), str(tmp_path / "run")
    events = raw(spark, [{"event_id": f"e{i % 3}", "arrival_seq": i} for i in range(5)])
    t.write_topic(t.raw_messages(events), "raw", log=root, batch="1")
    t.write_topic(spark.createDataFrame([("k", "{broken", None)], "key string, value string, headers array<struct<key:string,value:binary>>"), "raw", log=root)
    jobs.intake_job(t.read_topic(spark, "raw", log=root), out).awaitTermination()
    got = {r["outcome"]: r["count"] for r in spark.read.parquet(f"{out}/outcomes").groupBy("outcome").count().collect()}
    assert got == {"passed": 3, "duplicate": 2} and spark.read.parquet(f"{out}/dlq").count() == 1
