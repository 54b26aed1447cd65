"""Evaluate derived columns exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections cannot copy.

    The optimizer moves filters below projections and so repeats whatever a
    column was built from; for parsed JSON and long condition chains that
    multiplies both the work and the plan. A one-element ``inline`` stays where
    it is and is still part of the generated code.
    """
    packed = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select("*", F.inline(F.array(packed)))
