"""Bronze: every raw event, append-only, partitioned by provider, date and hour.

Beside the folders lies a manifest: a row per file with its folder, rows, bytes
and range of event times, kept at every write. What counts as written is what
the manifest names. Gap checks and statistics read it alone, scans open the files
it leaves, and a micro-batch that is repeated finds its epoch there.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curvewright.functions.payload import JSON_TEXT
from curvewright.schemas import RAW_EVENT
from curvewright.sources import files
from curvewright.sources.log_table import SEGMENT, LogTable

PARTITIONS = ("provider", "dt", "hh")
ROWS_PER_FILE = 5_000_000

# Raw events with nested columns as text, plus the arrival day and hour.
BRONZE_ROW = T.StructType(
    [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
        for f in RAW_EVENT.fields
    ]
    + [T.StructField("dt", T.StringType()), T.StructField("hh", T.StringType())]
)


def sanitise(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that mixed-type batches share one schema."""
    nested = (T.StructType, T.MapType, T.ArrayType, T.VariantType)
    return df.select(
        *[
            F.to_json(f.name, JSON_TEXT).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def reinflate(df: DataFrame) -> DataFrame:
    """Fault lists back to arrays; other JSON text is left for its readers."""
    return df.withColumn("injected_faults", F.from_json("injected_faults", "array<string>"))


def json_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text that looks like an object or a list as nested values; NULL elsewhere."""
    return df.withColumns(
        {
            f"{name}_value": F.when(
                F.substring(F.ltrim(name), 1, 1).isin("{", "["), F.try_parse_json(name)
            )
            for name in columns
        }
    )


def bronze_rows(raw: DataFrame) -> DataFrame:
    return sanitise(raw).withColumns(
        {
            "dt": F.date_format("received_at", "yyyy-MM-dd"),
            "hh": F.date_format("received_at", "HH"),
        }
    )


_FILE = "path string, provider string, dt string, hh string, rows long, bytes long, first_us long, last_us long, live boolean"


def _latest_state(rows: DataFrame) -> DataFrame:
    """A file's newest entry; files that a compaction replaced are left out."""
    entry = F.max_by(F.struct("provider", "dt", "hh", "rows", "bytes", "first_us", "last_us", "live"), SEGMENT)
    return rows.groupBy("path").agg(entry.alias("e")).select("path", "e.*").where("live")


def _log(spark: SparkSession, root: str) -> LogTable:
    # A removed file must stay removed while older segments that name it are merged: all at once.
    return LogTable(spark, f"{root}/_manifest", _latest_state)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files of Bronze: path below ``root``, provider, dt, hh, rows, bytes, first_event, last_event."""
    found = _log(spark, root).read()
    if found is None:
        found = spark.createDataFrame([], _FILE)
    return found.select(
        "path", "provider", "dt", "hh", "rows", "bytes",
        F.timestamp_micros("first_us").alias("first_event"), F.timestamp_micros("last_us").alias("last_event"),
    )


def _place(rows: DataFrame, root: str, name: str, again: bool = False) -> DataFrame:
    """Write rows and put their files into the folders of ``root``; the files' manifest entries.

    ``rebalance`` groups rows by partition folder, merges small groups and
    splits large ones by size, so a busy provider-hour neither floods one task
    nor leaves many small files. Files' names begin with ``name``; ``again`` says that
    a write of that name may have died, whose files are replaced. The driver renames
    folders that are new whole and never lists the files of a batch. The entries lie in
    the batch's incoming folder, which goes once they are in the manifest.
    """
    spark, incoming = rows.sparkSession, f"{root}/_incoming/{name}"
    (
        rows.hint("rebalance", *[F.col(p) for p in PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("mapreduce.output.basename", name)
        .partitionBy(*PARTITIONS)
        .parquet(f"{incoming}/rows")
    )
    # Footers and one column of what was just written. A path is a URI: "+" stands for itself.
    path = F.url_decode(F.replace(F.substring_index("_metadata.file_path", "/", -4), F.lit("+"), F.lit("%2B")))
    stats = (
        spark.read.schema(BRONZE_ROW).parquet(f"{incoming}/rows")
        .groupBy(path.alias("path"), *PARTITIONS, F.col("_metadata.file_size").alias("bytes"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(F.unix_micros("event_timestamp")).alias("first_us"),
            F.max(F.unix_micros("event_timestamp")).alias("last_us"),
        )
        .select("path", *PARTITIONS, "rows", "bytes", "first_us", "last_us", F.lit(True).alias("live"))
    )
    stats.write.mode("overwrite").parquet(f"{incoming}/entries")
    files.graft(spark, f"{incoming}/rows", root, f"{name}-" if again else None)
    return spark.read.schema(_FILE).parquet(f"{incoming}/entries")


def write_bronze(raw: DataFrame, root: str, epoch: int | None = None) -> None:
    """Append a batch; one with an ``epoch`` that the manifest holds is left alone."""
    spark = raw.sparkSession
    log = _log(spark, root)
    if epoch is not None and epoch <= log.manifest()["epoch"]:
        return
    name = f"b{uuid.uuid4().hex}" if epoch is None else f"e{epoch}"
    log.append(_place(bronze_rows(raw), root, name, epoch is not None), epoch)
    files.remove(spark, f"{root}/_incoming/{name}")


def compact_bronze(spark: SparkSession, root: str, before: datetime, most_files: int = 1) -> int:
    """Rewrite the hours before ``before`` that have more than ``most_files`` files; how many hours.

    One manifest entry replaces the small files by the large ones, so readers
    through the manifest see either; then the small ones go.
    """
    closed = before_hour(manifest(spark, root), before)
    many = closed.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_files).drop("n")
    same = [F.col(f"m.{p}").eqNullSafe(F.col(f"c.{p}")) for p in PARTITIONS]
    small = closed.alias("m").join(many.alias("c"), same, "left_semi").collect()
    if not small:
        return 0
    paths = [r["path"] for r in small]
    name = f"c{uuid.uuid4().hex}"
    entries = _place(read_files(spark, root, paths), root, name)
    gone = [(r["path"], r["provider"], r["dt"], r["hh"], r["rows"], r["bytes"], None, None, False) for r in small]
    _log(spark, root).append(entries.unionByName(spark.createDataFrame(gone, _FILE)))
    files.remove(spark, f"{root}/_incoming/{name}")
    for path in paths:
        files.remove(spark, f"{root}/{path}")
    return len({path.rpartition("/")[0] for path in paths})


def stream_bronze(
    raw: DataFrame, root: str, checkpoint: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Append a stream; ``every=None`` drains what is available and stops.

    A micro-batch leaves as few files an hour as a batch does; :func:`compact_bronze`
    joins those of closed hours.
    """
    writer = raw.writeStream.foreachBatch(lambda batch, epoch: write_bronze(batch, root, epoch))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The rows of chosen files."""
    if not paths:
        return spark.createDataFrame([], BRONZE_ROW)
    return spark.read.schema(BRONZE_ROW).option("basePath", root).parquet(*[f"{root}/{p}" for p in paths])


def scan_manifest(
    spark: SparkSession, root: str, provider: str, start: datetime, end: datetime,
    events: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """As :func:`scan_bronze`, opening only the files that the manifest leaves.

    ``events`` also leaves out files whose event times all lie outside it.
    """
    found = in_hours(manifest(spark, root).where(F.col("provider") == provider), start, end)
    if events:
        low, high = (F.lit(_utc(at)) for at in events)
        found = found.where((F.col("last_event") >= low) & (F.col("first_event") <= high))
    chosen = read_files(spark, root, [r["path"] for r in found.select("path").collect()])
    return scan_bronze(chosen, provider, start, end)


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Stored rows; partition values stay text, hour "07" is not the number 7."""
    return spark.read.schema(BRONZE_ROW).parquet(root)


def in_hours(bronze: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows whose partition hour lies in [start, end], pruned on folders.

    The start is cut to its hour so that a partial first hour is read.
    """
    low, high = _utc(start), _utc(end)
    low_day, high_day = low.strftime("%Y-%m-%d"), high.strftime("%Y-%m-%d")
    first = (F.col("dt") > low_day) | ((F.col("dt") == low_day) & (F.col("hh") >= low.strftime("%H")))
    last = (F.col("dt") < high_day) | ((F.col("dt") == high_day) & (F.col("hh") <= high.strftime("%H")))
    return bronze.where(F.col("dt").between(low_day, high_day) & first & last)


def before_hour(rows: DataFrame, at: datetime) -> DataFrame:
    """Rows of hours that have ended by ``at``."""
    day, hour = _utc(at).strftime("%Y-%m-%d"), _utc(at).strftime("%H")
    return rows.where((F.col("dt") < day) | ((F.col("dt") == day) & (F.col("hh") < hour)))


def scan_bronze(bronze: DataFrame, provider: str, start: datetime, end: datetime) -> DataFrame:
    return in_hours(bronze.where(F.col("provider") == provider), start, end)


def arrival_range(start: datetime, end: datetime, max_age: timedelta, max_future: timedelta):
    """Arrival hours that can hold rows with event times in [start, end].

    Folders follow arrival, jobs ask for event time: a late row lies in a later
    folder, a row from the future in an earlier one.
    """
    return start - max_future, end + max_age


def _utc(at: datetime) -> datetime:
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
