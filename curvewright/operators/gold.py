"""Forward-curve snapshots: tumbling windows, last write wins, quality gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvewright.functions.clock import after
from curvewright.functions.tenors import delivery_start

WINDOW_SECONDS = 300
MIN_COMPLETENESS = 0.80
AUTHORITATIVE_COMPLETENESS = 0.95
MIN_QUALITY = 0.70


def tenor_prices(curves: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Last arriving price per (curve, window, tenor).

    One aggregation with map-side combine; the arrival order is the ordering
    argument, so nothing is sorted by window or collected. The grouping is a
    time window, so the same plan runs on a stream with a watermark.
    """
    width = F.window("event_timestamp", f"{window_seconds} seconds")
    arrival = F.struct("ingestion_timestamp", "arrival_seq")
    first = F.struct("provider", "instrument")
    last = F.struct("price", "quality_score", "event_timestamp")
    return (
        curves.groupBy("curve_name", width.alias("window"), "tenor")
        .agg(
            F.max_by(last, arrival).alias("last"),
            F.min(F.struct(arrival.alias("arrival"), first.alias("first"))).alias("opening"),
            F.max("version").alias("version"),
            F.count(F.lit(1)).alias("events"),
        )
        .select(
            "curve_name",
            F.col("window.start").alias("window_start"),
            "tenor",
            F.col("last.price").alias("price"),
            F.col("last.quality_score").alias("quality_score"),
            F.col("last.event_timestamp").alias("last_updated"),
            "opening",
            "version",
            "events",
        )
    )


def window_rows(prices: DataFrame) -> DataFrame:
    """One row per (curve, window): tenor list, version, first instrument and provider."""
    entry = F.struct("tenor", "price", "quality_score", "last_updated")
    return (
        prices.groupBy("curve_name", "window_start")
        .agg(
            # A window holds each tenor once, and tenors are a closed set of labels.
            F.array_sort(F.collect_list(entry)).alias("entries"),
            F.min("opening").alias("_opening"),
            F.max("version").alias("version"),
            F.min("quality_score").alias("min_quality"),
            F.avg("quality_score").alias("avg_quality"),
            F.sum("events").alias("events"),
        )
        .select(
            "curve_name",
            "window_start",
            F.col("_opening.first.instrument").alias("instrument"),
            F.col("_opening.first.provider").alias("provider"),
            "entries",
            F.size("entries").alias("num_tenors"),
            "version",
            "min_quality",
            "avg_quality",
            "events",
        )
    )


def with_expected(
    windows: DataFrame, override: int = 0, earlier: DataFrame | None = None
) -> DataFrame:
    """Expected tenors: the override, or the most seen so far on the curve.

    ``earlier`` optionally carries ``(curve_name, expected_tenors)`` from
    windows closed before these.
    """
    if override > 0:
        return windows.withColumn("expected_tenors", F.lit(override))
    so_far = (
        Window.partitionBy("curve_name")
        .orderBy("window_start")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # One row per window: a curve has few, whatever its event rate.
    expected = F.max("num_tenors").over(so_far)
    if earlier is None:
        return windows.withColumn("expected_tenors", expected)
    known = earlier.select("curve_name", F.col("expected_tenors").alias("_known"))
    return (
        windows.withColumn("expected_tenors", expected)
        .join(known, "curve_name", "left")
        .withColumn("expected_tenors", F.greatest("expected_tenors", "_known"))
        .drop("_known")
    )


def assemble(
    windows: DataFrame,
    auth_completeness: float = AUTHORITATIVE_COMPLETENESS,
    min_quality: float = MIN_QUALITY,
) -> DataFrame:
    """Completeness and authority of every window."""
    ratio = F.when(
        F.col("expected_tenors") > 0, F.col("num_tenors") / F.col("expected_tenors")
    ).otherwise(0.0)
    return windows.withColumn("completeness", F.least(F.lit(1.0), ratio)).withColumn(
        "is_authoritative",
        (F.col("completeness") >= auth_completeness) & (F.col("min_quality") >= min_quality),
    )


def window_closed(as_of: Column, window_seconds: int) -> Column:
    """A window is final two widths after its end."""
    return after(F.col("window_start"), 3 * window_seconds) <= as_of


def closed_windows(windows: DataFrame, as_of: Column, window_seconds: int) -> DataFrame:
    return windows.where(window_closed(as_of, window_seconds))


def pending_count(windows: DataFrame, as_of: Column, window_seconds: int) -> DataFrame:
    """How many windows are still open."""
    return windows.where(~window_closed(as_of, window_seconds)).agg(
        F.count(F.lit(1)).alias("pending_windows")
    )


def gate(snapshots: DataFrame, min_completeness: float = MIN_COMPLETENESS) -> DataFrame:
    return snapshots.where(F.col("completeness") >= min_completeness)


def loadable(snapshots: DataFrame, write_non_authoritative: bool = False) -> DataFrame:
    if write_non_authoritative:
        return snapshots
    return snapshots.where("is_authoritative")


def flush_counts(gated: DataFrame, write_non_authoritative: bool = False) -> DataFrame:
    """Assembled, loaded and skipped totals of one flush."""
    loaded = F.lit(True) if write_non_authoritative else F.col("is_authoritative")
    return gated.agg(
        F.count(F.lit(1)).alias("assembled"),
        F.count_if(loaded).alias("loaded"),
        F.count_if(~loaded).alias("skipped"),
    )


def tenor_map() -> Column:
    """Tenor -> price, quality and last update."""
    return F.map_from_entries(
        F.transform(
            F.col("entries"),
            lambda x: F.struct(
                x["tenor"],
                F.struct(
                    x["price"].alias("price"),
                    x["quality_score"].alias("quality_score"),
                    x["last_updated"].alias("last_updated"),
                ),
            ),
        )
    )


def tenor_json() -> Column:
    """The map as JSON text; prices are text so that no digit is lost."""
    return F.to_json(
        F.map_from_entries(
            F.transform(
                F.col("entries"),
                lambda x: F.struct(
                    x["tenor"],
                    F.struct(
                        x["price"].cast("string").alias("price"),
                        x["quality_score"].alias("quality_score"),
                        F.date_format(x["last_updated"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(
                            "last_updated"
                        ),
                    ),
                ),
            )
        )
    )


def with_shape(
    snapshots: DataFrame, stale_after_seconds: int = 600, deviations: float = 3.0
) -> DataFrame:
    """Front price, slope, stale and outlier tenors.

    Slope is (last - first) / (n - 1) along delivery start. A tenor is stale
    when it was updated more than ``stale_after_seconds`` before the newest one,
    and an outlier when it lies more than ``deviations`` median absolute
    deviations from the median price.
    """
    ordered = F.array_sort(
        F.transform(
            F.col("entries"),
            lambda x: F.struct(
                delivery_start(x["tenor"]).alias("start"),
                x["price"].cast("double").alias("price"),
                x["last_updated"].alias("last_updated"),
            ),
        )
    )

    def median(sorted_values: Column) -> Column:
        n = F.size(sorted_values)
        low = F.element_at(sorted_values, F.floor((n + 1) / 2).cast("int"))
        high = F.element_at(sorted_values, F.floor(n / 2).cast("int") + 1)
        return (low + high) / 2

    shaped = (
        snapshots.withColumn("_ordered", ordered)
        .withColumn("_prices", F.array_sort(F.transform("_ordered", lambda x: x["price"])))
        .withColumn("_median", median(F.col("_prices")))
        .withColumn(
            "_spread",
            F.array_sort(F.transform("_prices", lambda p: F.abs(p - F.col("_median")))),
        )
        .withColumn("_mad", median(F.col("_spread")))
        .withColumn(
            "_newest", F.array_max(F.transform("_ordered", lambda x: x["last_updated"]))
        )
    )
    first = F.element_at("_ordered", 1)["price"]
    last = F.element_at("_ordered", -1)["price"]
    limit = F.lit(deviations) * F.col("_mad")
    return (
        shaped.withColumn("front_price", first)
        .withColumn(
            "curve_slope",
            F.when(F.col("num_tenors") > 1, (last - first) / (F.col("num_tenors") - 1)),
        )
        .withColumn(
            "stale_tenors",
            F.size(
                F.filter(
                    "_ordered",
                    lambda x: after(x["last_updated"], stale_after_seconds) < F.col("_newest"),
                )
            ),
        )
        .withColumn("outlier_tenors", F.size(F.filter("_spread", lambda d: d > limit)))
        .drop("_ordered", "_prices", "_median", "_spread", "_mad", "_newest")
    )


def snapshot_id() -> Column:
    return F.md5(
        F.concat_ws(
            "|", F.lit("snapshot"), "curve_name", F.unix_micros("window_start").cast("string")
        )
    )


def snapshot_rows(snapshots: DataFrame) -> DataFrame:
    """Gold table rows: the keyed snapshot plus the warehouse's reporting columns."""
    return snapshots.select(
        snapshot_id().alias("snapshot_id"),
        "curve_name",
        "instrument",
        "provider",
        F.col("window_start").alias("as_of"),
        F.col("window_start").alias("snapshot_time"),
        F.to_date("window_start").alias("curve_date"),
        tenor_map().alias("tenors"),
        tenor_json().alias("tenors_json"),
        "front_price",
        "curve_slope",
        "num_tenors",
        "completeness",
        (F.col("completeness") * 100).alias("completeness_pct"),
        F.col("avg_quality").alias("quality_score"),
        "is_authoritative",
        "version",
        "stale_tenors",
        "outlier_tenors",
    )


def snapshots(
    curves: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    as_of: Column | None = None,
    expected_override: int = 0,
) -> DataFrame:
    """Every assembled window, before the completeness gate."""
    windows = window_rows(tenor_prices(curves, window_seconds))
    if as_of is not None:
        windows = closed_windows(windows, as_of, window_seconds)
    return assemble(with_expected(windows, expected_override))


def gold_table(
    curves: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    as_of: Column | None = None,
    write_non_authoritative: bool = True,
    min_completeness: float = MIN_COMPLETENESS,
    stale_after_seconds: int = 600,
) -> DataFrame:
    """Gated snapshots in Gold table form."""
    gated = gate(snapshots(curves, window_seconds, as_of), min_completeness)
    return snapshot_rows(
        with_shape(loadable(gated, write_non_authoritative), stale_after_seconds)
    )
