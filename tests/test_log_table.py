"""The log-structured table: what is written, what readers see, what a repeat does."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from curvewright.sources import files
from curvewright.sources.log_table import LogTable, newest


def rows(spark, values):
    return spark.createDataFrame(values, "k string, day string, v long")


def table(spark, tmp_path, **options):
    return LogTable(spark, str(tmp_path / "t"), newest(["k", "day"]), day="day", **options)


def content(made):
    return sorted(tuple(r) for r in made.read().collect())


def written_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_newest_rows_win_across_segments_and_compactions(spark, tmp_path):
    made, want = table(spark, tmp_path, compact_after=3), {}
    assert made.read() is None
    for epoch in range(8):
        batch = [(f"k{(epoch * 3 + i) % 7}", f"2024-03-0{1 + (epoch + i) % 3}", epoch * 10 + i) for i in range(3)]
        want |= {(k, d): v for k, d, v in batch}
        made.append(rows(spark, batch), epoch)
        assert content(made) == sorted((k, d, v) for (k, d), v in want.items())
    assert made.read().columns == ["k", "day", "v"]


def test_a_repeated_epoch_is_taken_once(spark, tmp_path):
    made = table(spark, tmp_path)
    assert made.append(rows(spark, [("a", "2024-03-01", 1)]), 5).count() == 1
    assert made.append(rows(spark, [("a", "2024-03-01", 2)]), 5) is None
    assert content(made) == [("a", "2024-03-01", 1)]


def test_a_batch_that_dies_before_its_manifest_is_not_seen_and_is_written_again(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path)
    made.append(rows(spark, [("a", "2024-03-01", 1)]), 0)

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(files, "create", die)
        with pytest.raises(RuntimeError):
            made.append(rows(spark, [("b", "2024-03-01", 2), ("b", "2024-03-02", 2)]), 1)
    assert content(made) == [("a", "2024-03-01", 1)]
    made.append(rows(spark, [("b", "2024-03-01", 3)]), 1)
    assert content(made) == [("a", "2024-03-01", 1), ("b", "2024-03-01", 3)]


def test_two_writers_of_one_version_cannot_both_commit(spark, tmp_path):
    path = str(tmp_path / "1.json")
    files.create(spark, path, "first")
    with pytest.raises(FileExistsError):
        files.create(spark, path, "second")
    assert files.read_text(spark, path) == "first"


def test_readers_of_an_older_manifest_keep_their_rows(spark, tmp_path):
    made = table(spark, tmp_path, compact_after=2, keep=6)
    made.append(rows(spark, [("a", "2024-03-01", 1), ("a", "2024-03-02", 1)]), 0)
    reader, version = made.read(), made.manifest()["version"]
    for epoch in range(1, 4):
        made.append(rows(spark, [("a", "2024-03-01", epoch + 1)]), epoch)
    assert sorted(map(tuple, reader.collect())) == [("a", "2024-03-01", 1), ("a", "2024-03-02", 1)]
    assert sorted(map(tuple, made.read(version).collect())) == [("a", "2024-03-01", 1), ("a", "2024-03-02", 1)]
    assert content(made) == [("a", "2024-03-01", 4), ("a", "2024-03-02", 1)]


def test_bytes_follow_the_changes_and_untouched_days_stay(spark, tmp_path):
    made = table(spark, tmp_path, compact_after=4, keep=1)
    big = spark.range(20_000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
        F.concat(F.lit("2024-03-0"), (1 + F.col("id") % 9).cast("string")).alias("day"),
        F.xxhash64("id").alias("v"),
    )
    made.append(big, 0)
    made.compact()
    before = made.manifest()["base"]
    first = written_bytes(tmp_path)
    made.append(rows(spark, [("k0", "2024-03-01", 7)]), 1)
    assert written_bytes(tmp_path) - first < first / 20
    for epoch in range(2, 6):
        made.append(rows(spark, [("k0", "2024-03-01", epoch)]), epoch)
    after = made.manifest()["base"]
    assert {d for d in before if before[d] != after[d]} == {"day=2024-03-01"}
    assert made.read().count() == 20_000 and made.read(days=["day=2024-03-01"]).where("k = 'k0'").first()["v"] == 5
    # Segments that no kept manifest names are gone.
    named = set(after.values()) | {d["number"] for d in made.manifest()["deltas"]}
    assert len(files.names(spark, str(tmp_path / "t" / "data"))) <= len(named) + 6


def test_an_empty_batch_counts_as_an_epoch(spark, tmp_path):
    made = table(spark, tmp_path)
    made.append(rows(spark, []), 0)
    assert made.manifest()["epoch"] == 0 and content(made) == []
    whole = LogTable(spark, str(tmp_path / "w"), newest(["k"]))
    whole.append(rows(spark, []), 0)
    whole.append(rows(spark, [("a", "d", 1)]), 1)
    whole.compact()
    assert content(whole) == [("a", "d", 1)]
