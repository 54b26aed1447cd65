"""Registered queries: a Spark function and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvewright.plans.oracle_ctes import sql as with_tables
from curvewright.plans.stages import Stages

_BUILDERS: dict[str, Callable[[Stages], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``name``; ``sql`` may use the tables of ``oracle_ctes``."""

    def register(build: Callable[[Stages], DataFrame]):
        if name in _BUILDERS:
            raise ValueError(f"query {name} registered twice")
        _BUILDERS[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Column types that compare alike across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def r6(column: str):
    return F.round(F.col(column).cast("double"), 6).alias(column)


def _load() -> None:
    from curvewright.plans import (  # noqa: F401
        queries_monitor,
        queries_serving,
        queries_sources,
        queries_stages,
        queries_views,
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def runner(build):
        return lambda spark, sf_dir: plain(build(Stages(spark, sf_dir)))

    return {name: runner(build) for name, build in _BUILDERS.items()}


def all_sql() -> dict[str, str]:
    _load()
    return {name: with_tables(text) for name, text in _SQL.items()}
