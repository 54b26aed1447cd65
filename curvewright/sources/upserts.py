"""Idempotent loads into Parquet tables partitioned by day.

Portable upserts, one writer per table: Silver appends ids of the days a batch
touches, Gold appends segments that a reader merges. With a transactional table
format the same keys go into its MERGE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from curvewright.sources.log_table import LogTable, newest


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _days(batch: DataFrame, column: str) -> list:
    """The days in a batch: a handful of values, whatever its size."""
    return [row[0] for row in batch.select(column).distinct().collect()]


def one_per_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key in ``order``; combined map-side, so hot keys stay cheap."""
    others = [c for c in rows.columns if c not in key]
    packed = F.struct(*order, F.struct(*others).alias("_row"))
    return rows.groupBy(*key).agg(F.min(packed).alias("_first")).select(
        *key, *[F.col(f"_first._row.{c}").alias(c) for c in others]
    )


def staged(rows: DataFrame, path: str) -> DataFrame:
    """Write rows once and go on from the written table."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def load_silver(batch: DataFrame, path: str, staging: str) -> None:
    """Append the batch's new event ids; ids loaded before are left alone."""
    spark = batch.sparkSession
    fresh = staged(one_per_key(batch, ["event_id"], ["received_at"]), staging)
    loaded = existing_table(spark, path)
    if loaded is not None:
        days = _days(fresh, "curve_date")
        seen = loaded.where(F.col("curve_date").isin(days)).select("curve_date", "event_id")
        fresh = fresh.join(seen, ["curve_date", "event_id"], "left_anti")
    (
        fresh.hint("rebalance", F.col("curve_date"))
        .write.mode("append")
        .partitionBy("curve_date")
        .parquet(path)
    )


GOLD_KEY = ["curve_name", "as_of"]


def merge_counts(existing: DataFrame | None, batch: DataFrame) -> DataFrame:
    """How many rows of the batch are new and how many replace a row."""
    if existing is None:
        return batch.agg(
            F.count(F.lit(1)).alias("inserted"), F.lit(0).cast("bigint").alias("updated")
        )
    present = existing.select(*GOLD_KEY, F.lit(1).alias("_present"))
    return batch.join(present, GOLD_KEY, "left").agg(
        F.count_if(F.col("_present").isNull()).alias("inserted"),
        F.count_if(F.col("_present").isNotNull()).alias("updated"),
    )


def gold_table(spark: SparkSession, path: str) -> LogTable:
    """Gold: the latest snapshot of each (curve_name, as_of), by day."""
    return LogTable(spark, path, newest(GOLD_KEY), day="curve_date")


def merge_gold(batch: DataFrame, path: str, epoch: int | None = None) -> dict[str, int]:
    """Upsert snapshots; returns inserted and updated counts, none for a repeated epoch.

    Only the batch is written; of what was there before, the keys of the days it
    touches are read. See :mod:`curvewright.sources.log_table`.
    """
    table = gold_table(batch.sparkSession, path)
    before = table.manifest()["version"]
    written = table.append(batch, epoch)
    if written is None:
        return {"inserted": 0, "updated": 0}
    days = [f"curve_date={day}" for day in _days(written, "curve_date")]
    existing = table.read(before, days) if before else None
    return merge_counts(existing, written).first().asDict()
