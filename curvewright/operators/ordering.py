"""Running positions and sums over hot keys.

A window over ``(key, arrival order)`` puts a whole key in one task. A key here
may hold a third of all rows, so rows are range-partitioned on (key, order)
instead, with bounds the engine samples: a task holds a bounded number of rows
however they spread over keys and times. A position is the row's place in its
partition plus a prefix sum over the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvewright.schemas import ARRIVAL_ORDER
from curvewright.session import fresh_path


def running_position(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    order: Sequence[str] = ARRIVAL_ORDER,
    start: DataFrame | None = None,
) -> DataFrame:
    """1-based position of every row within its key, in ``order``.

    ``start`` optionally carries ``(keys, <name>)`` with the last position
    handed out earlier. The ordered rows are written to the shared folder:
    places in a partition hold only for the one exchange that made it.
    """
    path = fresh_path(df.sparkSession, "ordered")
    (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
        .write.parquet(path)
    )
    rows = df.sparkSession.read.parquet(path)
    groups = [*keys, "_part"]
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1)
        .drop("_rows", "_first")
    )
    if start is not None:
        carried = start.select(*keys, F.col(name).alias("_carried"))
        offsets = (
            offsets.join(carried, list(keys), "left")
            .withColumn("_before", F.col("_before") + F.coalesce("_carried", F.lit(0)))
            .drop("_carried")
        )
    joined = rows.alias("n").join(
        offsets.alias("o"),
        on=[F.col(f"n.{g}").eqNullSafe(F.col(f"o.{g}")) for g in groups],
    )
    return joined.select(
        *[F.col(f"n.{c}") for c in df.columns],
        (F.col("n._row") + F.col("o._before")).alias(name),
    )


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows overall, found without gathering them in one task."""
    placed = running_position(df.withColumn("_all", F.lit(1)), ["_all"], "_position", order)
    return placed.where(F.col("_position") <= n).drop("_all", "_position")


def next_arrival(df: DataFrame, keys: Sequence[str], clock: str, name: str) -> DataFrame:
    """Distinct times of each key with the time that follows (NULL for the last)."""
    times = df.groupBy(*keys, clock).agg(F.count(F.lit(1)).alias("events"))
    placed = running_position(times, keys, "_place", [clock])
    following = placed.select(*keys, (F.col("_place") - 1).alias("_place"), F.col(clock).alias(name))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"f.{k}")) for k in (*keys, "_place")]
    return placed.alias("t").join(following.alias("f"), same, "left").select(
        *[F.col(f"t.{c}") for c in (*keys, clock, "events")], F.col(f"f.{name}").alias(name)
    )
