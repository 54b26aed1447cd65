"""Reading the open JSON payload without trusting its types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds and nulls survive the trip through text.
JSON_TEXT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def as_variant(payload: Column) -> Column:
    """Parse once; text that is not JSON becomes NULL."""
    return F.try_parse_json(payload)


def json_type(variant: Column) -> Column:
    """``STRING``, ``BIGINT``, ``OBJECT<...>``, ``VOID`` (JSON null) or NULL (absent)."""
    return F.schema_of_variant(variant)


def field(variant: Column, name: str) -> Column:
    return F.try_variant_get(variant, f"$.{name}", "variant")


def is_object(kind: Column) -> Column:
    return F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False))


def is_number(kind: Column) -> Column:
    """Booleans count as numbers here, as they do in the feed's own checks."""
    return kind.rlike(_NUMBER) | (kind == "BOOLEAN")


def is_missing(kind: Column) -> Column:
    """Absent and JSON null both mean that there is no value."""
    return kind.isNull() | (kind == "VOID")


def type_label(kind: Column) -> Column:
    """The type name that failure reasons quote."""
    return (
        F.when(kind == "STRING", "str")
        .when(F.startswith(kind, F.lit("ARRAY")), "list")
        .when(F.startswith(kind, F.lit("OBJECT")), "dict")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "BIGINT", "int")
        .when(kind == "VOID", "NoneType")
        .otherwise("float")
    )
