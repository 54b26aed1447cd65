"""Silver and dead-letter table rows in warehouse form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvewright.schemas import CURVE_EVENT

SILVER_COLUMNS = tuple(name for name in CURVE_EVENT.fieldNames() if name != "arrival_seq")


def bronze_prefix(provider: Column, received_at: Column) -> Column:
    """Folder of the Bronze files that hold a row."""
    return F.concat(
        F.lit("bronze/provider="),
        provider,
        F.date_format(received_at, "'/dt='yyyy-MM-dd'/hh='HH"),
    )


def silver_rows(curves: DataFrame) -> DataFrame:
    """The typed curve-event columns plus the warehouse's reporting columns."""
    return curves.select(
        *SILVER_COLUMNS,
        F.col("ingestion_timestamp").alias("received_at"),
        F.to_date("event_timestamp").alias("curve_date"),
        F.lit("PASSED").alias("validation_status"),
        bronze_prefix(F.col("provider"), F.col("ingestion_timestamp")).alias("bronze_key"),
    )
