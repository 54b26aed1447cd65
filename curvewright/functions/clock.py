"""Time arithmetic on explicit clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(later: Column, earlier: Column) -> Column:
    """Fractional seconds, exact to the microsecond."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def floor_to(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned window of ``seconds`` holding ``ts``."""
    whole = F.unix_seconds(ts)
    return F.timestamp_seconds(whole - F.pmod(whole, F.lit(seconds)))


def after(ts: Column, seconds: int | float) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(int(seconds * 1_000_000)).cast("bigint"))


def utc(value: Column) -> Column:
    """Parse ISO text; text without an offset is UTC (the session zone)."""
    return value.try_cast("timestamp")
