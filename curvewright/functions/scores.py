"""Quality scores from fault lists.

Penalties are whole hundredths, so sums are exact integers and the score is a
single division at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curvewright.schemas import CURVE_PENALTIES, VALIDATION_PENALTIES


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms, F.lit(0))


def _left(hundredths_lost: Column) -> Column:
    return F.greatest(F.lit(0), F.lit(100) - hundredths_lost)


def validation_points(faults: Column) -> Column:
    """Score in hundredths; each occurrence of a fault costs its penalty."""
    listed = F.coalesce(faults, F.array().cast("array<string>"))
    lost = [
        (F.size(listed) - F.size(F.array_remove(listed, name))) * F.lit(cost)
        for name, cost in VALIDATION_PENALTIES.items()
    ]
    return _left(_total(lost))


def validation_score(faults: Column) -> Column:
    """Score in [0, 1] of one event at validation."""
    return validation_points(faults).cast("double") / F.lit(100.0)


def curve_score(faults: Column) -> Column:
    """Each distinct fault costs its penalty once; other faults are free."""
    listed = F.coalesce(faults, F.array().cast("array<string>"))
    lost = [
        F.when(F.array_contains(listed, name), F.lit(cost)).otherwise(F.lit(0))
        for name, cost in CURVE_PENALTIES.items()
    ]
    return _left(_total(lost)).cast("double") / F.lit(100.0)
