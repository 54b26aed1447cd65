"""Raw market events derived from the given ``events`` table.

The derivation is arithmetic on the table's own columns, so the same rows can
be written down in SQL. It exercises every rule: repeats inside and beyond the
time to live, rows out of bounds, unknown symbols, every tenor form and prices
of the wrong type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The derived feed depends on these lists and their order.
SYMBOLS = ("TTF", "NBP GAS", " brn ", "CL", "EUA", "TTFPOWER", "ttf_gas", "UNKNOWN_X")
TENORS = (
    "2024-03",
    "2024-4",
    "MAY24",
    "Jun-24",
    "Jul-2024",
    "August 2024",
    "M+1",
    "M+7",
    "Q1-2024",
    "2024Q3",
    "Q+2",
    "Summer 2024",
    "WIN25",
    "Cal-2025",
    "2026",
    "spot",
    "2024-13",
    "GARBAGE",
    "",
    None,
)
PROVIDERS = ("a", "b", "c")


#: Session setting: over how many tasks a scanned table is dealt. Unset, a scan has the
#: tasks its files give it, as tables of many files need; a table that is one row group
#: is one task, and everything derived from it row by row would run in that one.
SPREAD = "curvewright.input.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; how many tasks its rows go through is the reader's setting."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    spread = spark.conf.get(SPREAD, None)
    return rows.repartition(int(spread)) if spread else rows


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _every(n: int, rest: int = 0) -> Column:
    return F.col("e") % n == rest


def _shift(ts: Column, seconds: Column | int) -> Column:
    amount = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_micros(F.unix_micros(ts) + amount.cast("bigint") * 1_000_000)


def payload_text() -> Column:
    """The payload as JSON text, with absent, null, wrong-typed and real prices."""
    tenor = _pick(TENORS, F.pmod(F.col("k"), F.lit(len(TENORS))))
    price = (
        F.when(_every(89), '"price":"~~CORRUPTED~~",')
        .when(_every(83), '"price":null,')
        .when(_every(79), "")
        .when(_every(97), F.concat(F.lit('"price":'), (-F.col("value")).cast("string"), F.lit(",")))
        .otherwise(F.concat(F.lit('"price":'), F.col("value").cast("string"), F.lit(",")))
    )
    tenor_json = F.coalesce(F.concat(F.lit('"'), tenor, F.lit('"')), F.lit("null"))
    return F.concat(
        F.lit("{"),
        price,
        F.lit('"tenor":'),
        tenor_json,
        F.lit(',"volume":'),
        F.col("k").cast("string"),
        F.lit(',"currency":"GBP","unit":"therm","schema_version":"1.0"}'),
    )


def fault_list() -> Column:
    rules = (
        ("stale", _every(101)),
        ("out_of_order", _every(103)),
        ("malformed", _every(97) | _every(89)),
        ("delayed", _every(20)),
        ("schema_drift", _every(37)),
        ("partial_curve", _every(41)),
        ("duplicate", _every(50, 7)),
        ("delayed", _every(60)),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules]))


def raw_market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived raw feed; ``copy_no`` 1 marks the re-delivered rows."""
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    copies = base.withColumn(
        "copy_no",
        F.explode(F.when(_every(50, 7), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    )
    copy_delay = F.when(_every(100, 57), 7200).otherwise(50) * F.col("copy_no")
    return copies.select(
        F.when(_every(211, 5), "").otherwise(F.concat(F.lit("ev-"), F.col("e"))).alias("event_id"),
        F.when(_every(199, 3), "")
        .otherwise(F.concat(F.lit("provider-"), _pick(PROVIDERS, F.col("u") % 3)))
        .alias("provider"),
        _pick(SYMBOLS, F.col("u") % len(SYMBOLS)).alias("instrument"),
        _shift(F.col("ts"), F.col("e") % 45 + copy_delay).alias("received_at"),
        F.when(_every(101), _shift(F.col("ts"), -30 * 3600))
        .when(_every(103), _shift(F.col("ts"), 600))
        .otherwise(F.col("ts"))
        .alias("event_timestamp"),
        payload_text().alias("payload"),
        fault_list().alias("injected_faults"),
        F.lit(False).alias("is_replay"),
        F.lit(None).cast("string").alias("replay_source"),
        F.concat(F.lit("tr-"), F.col("e")).alias("trace_id"),
        (F.col("e") * 2 + F.col("copy_no")).alias("arrival_seq"),
    )


def query_clock(raw: DataFrame) -> Column:
    """The newest arrival, as a scalar subquery: the ``as_of`` of every query."""
    return raw.agg(F.max("received_at")).scalar()
