"""Validated event -> canonical curve event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvewright.functions import payload as P
from curvewright.functions.pin import pin
from curvewright.functions.scores import curve_score
from curvewright.functions.tenors import (
    canonical_tenor,
    delivery_period,
    stripped,
    tenor_shape,
    tenor_text,
)
from curvewright.operators.ordering import running_position
from curvewright.schemas import INSTRUMENT_ALIASES, INSTRUMENT_UNITS, PRICE


def _constant_map(pairs: dict[str, str]) -> Column:
    """A literal map: at 16 entries a lookup needs no join at all."""
    entries = ", ".join(f"'{key}', '{value}'" for key, value in pairs.items())
    return F.expr(f"map({entries})")


def canonical_instrument(symbol: Column) -> Column:
    """Canonical symbol, or NULL when the alias is unknown."""
    return F.element_at(_constant_map(INSTRUMENT_ALIASES), F.upper(stripped(symbol)))


def is_known_instrument(symbol: Column) -> Column:
    return canonical_instrument(symbol).isNotNull()


def instrument_currency(canonical: Column) -> Column:
    return F.element_at(_constant_map({k: v[0] for k, v in INSTRUMENT_UNITS.items()}), canonical)


def instrument_unit(canonical: Column) -> Column:
    return F.element_at(_constant_map({k: v[1] for k, v in INSTRUMENT_UNITS.items()}), canonical)


def curve_name(canonical: Column, period: Column) -> Column:
    return F.concat_ws("_", canonical, F.upper(period), F.lit("FWD"))


def raw_tenor(tenor: Column, kind: Column, symbol: Column) -> Column:
    """Tenor text to interpret: an absent or empty tenor falls back to the
    symbol; a JSON null reads as the text ``None``, which no form accepts."""
    text = F.try_variant_get(tenor, "$", "string")
    return (
        F.when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(kind.isNull() | (text == ""), symbol)
        .otherwise(text)
    )


def interpret(validated: DataFrame) -> DataFrame:
    """Add canonical fields and ``reject_reason`` (NULL when usable)."""
    fields = pin(
        validated.withColumn("_doc", P.as_variant(F.col("payload"))),
        {
            "_price": P.field(F.col("_doc"), "price"),
            "_tenor": P.field(F.col("_doc"), "tenor"),
            "canonical": canonical_instrument(F.col("instrument")),
        },
    )
    kinds = pin(
        fields,
        {
            "_price_kind": P.json_type(F.col("_price")),
            "_text": tenor_text(
                raw_tenor(F.col("_tenor"), P.json_type(F.col("_tenor")), F.col("instrument"))
            ),
        },
    )
    shaped = pin(kinds, {"_shape": tenor_shape(F.col("_text"))})
    mapped = pin(
        shaped,
        {
            "tenor": canonical_tenor(F.col("_text"), F.col("_shape"), F.col("received_at")),
            "price": F.when(
                F.col("_price_kind") != "BOOLEAN",
                F.try_variant_get(F.col("_price"), "$", PRICE.simpleString()),
            ),
        },
    )
    reason = (
        F.when(F.col("canonical").isNull(), "unknown_instrument")
        .when(P.is_missing(F.col("_price_kind")), "missing_price")
        .when(F.col("price").isNull(), "invalid_price")
        .when(F.col("tenor").isNull(), "unknown_tenor")
    )
    return mapped.withColumn("reject_reason", reason).drop(
        "_doc", "_price", "_price_kind", "_tenor", "_text", "_shape"
    )


def reject_counts(interpreted: DataFrame) -> DataFrame:
    """Rows that cannot become curve events, by provider and reason."""
    return (
        interpreted.where(F.col("reject_reason").isNotNull())
        .groupBy("provider", "reject_reason")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def curve_rows(interpreted: DataFrame) -> DataFrame:
    """Usable rows as curve events, still without a version."""
    usable = interpreted.where(F.col("reject_reason").isNull())
    named = usable.withColumn("delivery_period", delivery_period(F.col("tenor"))).withColumn(
        "curve_name", curve_name(F.col("canonical"), F.col("delivery_period"))
    )
    return named.select(
        F.md5(F.concat_ws("|", F.lit("curve"), "event_id")).alias("event_id"),
        F.col("event_id").alias("source_event_id"),
        "curve_name",
        F.col("canonical").alias("instrument"),
        "tenor",
        "delivery_period",
        "price",
        instrument_currency(F.col("canonical")).alias("currency"),
        instrument_unit(F.col("canonical")).alias("unit"),
        "provider",
        "event_timestamp",
        F.col("received_at").alias("ingestion_timestamp"),
        curve_score(F.col("injected_faults")).alias("quality_score"),
        "is_replay",
        "replay_source",
        "trace_id",
        "arrival_seq",
    )


def with_versions(curves: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Number the events of each curve in arrival order, from 1."""
    return running_position(
        curves,
        ["curve_name"],
        "version",
        order=("ingestion_timestamp", "arrival_seq"),
        start=start,
    )


def normalise(validated: DataFrame, versions_from: DataFrame | None = None) -> DataFrame:
    """Curve events with versions; unusable rows are left out."""
    return with_versions(curve_rows(interpret(validated)), versions_from)
