"""Landing files and the typed projections that load them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value in landing files.
NULL_TEXTS = ("NULL", "null", "")

# Target columns and types of each load.
CURVE_EVENT_COLUMNS = {
    "event_id": "string",
    "provider": "string",
    "instrument": "string",
    "instrument_type": "string",
    "venue": "string",
    "curve_date": "date",
    "tenor": "string",
    "tenor_months": "int",
    "price": "decimal(20,8)",
    "bid": "decimal(20,8)",
    "ask": "decimal(20,8)",
    "settlement_price": "decimal(20,8)",
    "volume": "decimal(20,4)",
    "open_interest": "decimal(20,4)",
    "currency": "string",
    "unit": "string",
    "validation_status": "string",
    "validation_version": "string",
    "quality_score": "decimal(5,4)",
    "event_timestamp": "timestamp",
    "received_at": "timestamp",
    "bronze_s3_key": "string",
    "batch_id": "string",
    "trace_id": "string",
    "source_schema_ver": "string",
}
DLQ_COLUMNS = {
    "dlq_event_id": "string",
    "original_event_id": "string",
    "provider": "string",
    "instrument": "string",
    "failure_reason": "string",
    "failure_category": "string",
    "dlq_timestamp": "timestamp",
    "retry_count": "int",
    "retry_status": "string",
    "trace_id": "string",
}
SNAPSHOT_COLUMNS = {
    "snapshot_id": "string",
    "provider": "string",
    "instrument": "string",
    "instrument_type": "string",
    "currency": "string",
    "unit": "string",
    "curve_date": "date",
    "tenors": "string",
    "front_price": "decimal(20,8)",
    "curve_slope": "decimal(20,8)",
    "num_tenors": "int",
    "quality_score": "decimal(5,4)",
    "completeness_pct": "decimal(5,2)",
    "stale_tenors": "int",
    "outlier_tenors": "int",
    "snapshot_time": "timestamp",
    "batch_id": "string",
    "trace_id": "string",
}
QUALITY_COLUMNS = {
    "quality_history_id": "string",
    "provider": "string",
    "quality_score": "decimal(5,4)",
    "events_count": "int",
    "dlq_count": "int",
    "warning_count": "int",
    "completeness_pct": "decimal(5,2)",
    "avg_latency_ms": "decimal(10,2)",
    "p99_latency_ms": "decimal(10,2)",
    "measurement_window": "string",
    "window_start": "timestamp",
    "window_end": "timestamp",
    "snapshot_time": "timestamp",
}


def read_landing(spark: SparkSession, path: str, array_files: bool = False) -> DataFrame:
    """Landing documents as one JSON text per row.

    Line-delimited files split freely. A file that is one outer array
    (``array_files``) is read whole and its elements become rows; its codec is
    recognised by the extension in both cases.
    """
    if not array_files:
        return spark.read.text(path).where("trim(value) <> ''").select(
            F.col("value").alias("document")
        )
    return documents_of_arrays(spark.read.text(path, wholetext=True))


def documents_of_arrays(arrays: DataFrame) -> DataFrame:
    """The elements of JSON array texts, one per row."""
    elements = F.explode(F.from_json("value", "array<variant>"))
    return arrays.select(elements.alias("v")).select(F.to_json("v").alias("document"))


def null_if(text: Column) -> Column:
    return F.when(~text.isin(*NULL_TEXTS), text)


def _typed(document: str, columns: dict[str, str], zeros: tuple[str, ...] = ()) -> list[Column]:
    """One text parse per document; anything that does not fit its type is NULL."""
    out = []
    for name, kind in columns.items():
        value = null_if(F.col(f"{document}.{name}")).try_cast(kind)
        out.append((F.coalesce(value, F.lit(0)) if name in zeros else value).alias(name))
    return out


def _parsed(documents: DataFrame, columns: dict[str, str]) -> DataFrame:
    texts = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return documents.withColumn("_d", F.from_json("document", texts))


def silver_pipe(documents: DataFrame) -> DataFrame:
    return _parsed(documents, CURVE_EVENT_COLUMNS).select(
        *_typed("_d", CURVE_EVENT_COLUMNS), F.col("document").alias("raw_payload")
    )


def dlq_pipe(documents: DataFrame) -> DataFrame:
    return _parsed(documents, DLQ_COLUMNS).select(
        *_typed("_d", DLQ_COLUMNS, ("retry_count",)), F.col("document").alias("raw_payload")
    )


def gold_pipe(documents: DataFrame) -> DataFrame:
    return _parsed(documents, SNAPSHOT_COLUMNS).select(
        *_typed("_d", SNAPSHOT_COLUMNS, ("stale_tenors", "outlier_tenors"))
    )


def quality_pipe(documents: DataFrame) -> DataFrame:
    return _parsed(documents, QUALITY_COLUMNS).select(
        *_typed("_d", QUALITY_COLUMNS, ("dlq_count", "warning_count"))
    )
