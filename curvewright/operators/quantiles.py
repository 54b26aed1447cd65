"""Exact quantiles of whole-number measures without holding a group in memory.

The built-in exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here equal values are counted first, a prefix sum over
coarse cells finds the cell that holds each wanted rank, and only those cells
are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n")
    )


def exact_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    cell: int = 4096,
) -> DataFrame:
    """Linearly interpolated quantiles, one column per entry of ``probabilities``.

    ``counts`` holds ``(keys, value, n)``; ``value`` is a whole number. Keys
    must not be NULL.
    """
    # One row per value even when the caller counted at a finer grain.
    counts = counts.groupBy(*keys, value).agg(F.sum("n").alias("n")).withColumn(
        "_cell", F.floor(F.col(value) / F.lit(cell))
    )
    by_cell = Window.partitionBy(*keys).orderBy("_cell")
    cells = (
        counts.groupBy(*keys, "_cell")
        .agg(F.sum("n").alias("_in_cell"))
        .withColumn("_upto", F.sum("_in_cell").over(by_cell.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_in_cell").over(Window.partitionBy(*keys)))
        .withColumn("_from", F.col("_upto") - F.col("_in_cell"))
    )
    wanted = [
        F.struct(
            F.lit(label).alias("label"),
            (F.lit(q) * (F.col("_total") - 1)).alias("rank"),
        )
        for label, q in probabilities.items()
    ]
    targets = (
        cells.withColumn("_want", F.explode(F.array(*wanted)))
        .select(
            *keys,
            "_cell",
            "_from",
            "_upto",
            F.col("_want.label").alias("_label"),
            F.col("_want.rank").alias("_rank"),
        )
        .withColumn("_low", F.floor("_rank"))
        .withColumn("_high", F.ceil("_rank"))
        .where(
            ((F.col("_low") >= F.col("_from")) & (F.col("_low") < F.col("_upto")))
            | ((F.col("_high") >= F.col("_from")) & (F.col("_high") < F.col("_upto")))
        )
    )
    in_cell = Window.partitionBy(*keys, "_cell", "_label").orderBy(value)
    ranked = (
        counts.join(targets, [*keys, "_cell"])
        .withColumn("_end", F.col("_from") + F.sum("n").over(in_cell))
        .withColumn("_begin", F.col("_end") - F.col("n"))
    )

    def at(rank: str) -> F.Column:
        inside = (F.col(rank) >= F.col("_begin")) & (F.col(rank) < F.col("_end"))
        return F.max(F.when(inside, F.col(value)))

    per_label = ranked.groupBy(*keys, "_label").agg(
        at("_low").alias("_a"),
        at("_high").alias("_b"),
        F.max("_rank").alias("_rank"),
    ).withColumn(
        "_value",
        F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_rank") - F.floor("_rank")),
    )
    return per_label.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_label") == label, F.col("_value"))).alias(label)
            for label in probabilities
        ]
    )
