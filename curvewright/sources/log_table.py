"""Tables kept as appended segments, made one by a merge, with manifests.

A batch is written once, as a segment of its own, and counts from the moment a
manifest names it. Readers take the newest manifest and merge the segments it
names; nothing they read is ever overwritten, so they never see a half-replaced
table. Every few segments the days these touch are merged into one base segment
each; days without changes keep theirs. Bytes written thus follow what changes.

Manifest number n is ``_manifests/n.json``; ``data/seg=n`` is the segment
written for it. A batch that carries an epoch is taken once: a repeated epoch
finds itself in the manifest.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvewright.sources import files

SEGMENT = "seg"
_NOTHING = {"version": 0, "epoch": -1, "schema": None, "base": {}, "deltas": []}

Merge = Callable[[DataFrame], DataFrame]


def newest(key: Sequence[str]) -> Merge:
    """Of the rows of a key those of the latest segment; a segment holds a key once."""

    def merge(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in (*key, SEGMENT)]
        last = F.max_by(F.struct(*others), SEGMENT).alias("_last")
        return rows.groupBy(*key).agg(last).select(*key, *[F.col(f"_last.{c}").alias(c) for c in others])

    return merge


@dataclass(frozen=True)
class LogTable:
    """``merge`` turns the rows of several segments (with column SEGMENT) into the table's.

    It must give the same if some segments are merged before, as a newest row, a
    sum, a maximum or the best n do. ``day`` names the column segments are
    partitioned by; without it every compaction rewrites the whole table.
    ``compact_after`` segments are merged at once; ``keep`` older manifests stay
    readable.
    """

    spark: SparkSession
    path: str
    merge: Merge
    day: str | None = None
    compact_after: int = 8
    keep: int = 16

    # -- manifests -----------------------------------------------------------

    def _versions(self) -> list[int]:
        found = files.names(self.spark, f"{self.path}/_manifests")
        return sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, version: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.path}/_manifests/{version}.json"))

    def manifest(self) -> dict:
        versions = self._versions()
        return self._manifest(versions[-1]) if versions else dict(_NOTHING)

    def _commit(self, manifest: dict) -> None:
        files.create(self.spark, f"{self.path}/_manifests/{manifest['version']}.json", json.dumps(manifest))

    # -- writing -------------------------------------------------------------

    def _write(self, rows: DataFrame, number: int) -> list[str]:
        """Write a segment; the names of its day folders ('' without days)."""
        folder = f"{self.path}/data/{SEGMENT}={number}"
        if self.day is None:
            rows.write.mode("overwrite").parquet(folder)
            return [""]
        writer = rows.hint("rebalance", F.col(self.day)).write.mode("overwrite").partitionBy(self.day)
        # All days of the folder: a batch that died here may have left others.
        writer.option("partitionOverwriteMode", "static").parquet(folder)
        return [n for n in files.names(self.spark, folder) if n.startswith(f"{self.day}=")]

    def append(self, rows: DataFrame, epoch: int | None = None) -> DataFrame | None:
        """Add a batch; the rows as written, or None if its epoch had been taken before."""
        before = self.manifest()
        if epoch is not None and epoch <= before["epoch"]:
            return None
        number = before["version"] + 1
        days = self._write(rows, number)
        delta = {"number": number, "days": days}
        self._commit(
            before
            | {"version": number, "epoch": before["epoch"] if epoch is None else epoch}
            | {"schema": rows.schema.jsonValue(), "deltas": [*before["deltas"], delta]}
        )
        written = self._rows(rows.schema, [f"{number}/{day}" for day in days])
        if len(before["deltas"]) + 1 >= self.compact_after:
            self.compact()
        return written

    def compact(self) -> None:
        """Merge the days that deltas touch into one base segment; others stay as they are."""
        before = self.manifest()
        touched = sorted({day for delta in before["deltas"] for day in delta["days"]})
        number = before["version"] + 1
        base = dict(before["base"])
        if touched:
            schema = T.StructType.fromJson(before["schema"])
            rows = self.merge(self._rows(schema, self._folders(before, set(touched))))
            kept = self._write(rows.select(*schema.names), number)
            base = {day: n for day, n in base.items() if day not in touched} | dict.fromkeys(kept, number)
        self._commit(before | {"version": number, "base": base, "deltas": []})
        self._clean(number)

    def _clean(self, newest_version: int) -> None:
        """Remove segments that none of the last ``keep`` manifests before a compaction names."""
        versions = self._versions()
        live = set()
        for version in versions[-(self.keep + 1) :]:
            made = self._manifest(version)
            live |= set(made["base"].values()) | {d["number"] for d in made["deltas"]}
        for name in files.names(self.spark, f"{self.path}/data"):
            number = int(name.partition("=")[2])
            if number not in live and number < newest_version:
                files.remove(self.spark, f"{self.path}/data/{name}")
        for version in versions[: -(self.keep + 1)]:
            files.remove(self.spark, f"{self.path}/_manifests/{version}.json")

    # -- reading -------------------------------------------------------------

    @staticmethod
    def _folders(manifest: dict, days: set[str] | None = None) -> list[str]:
        found = [f"{number}/{day}" for day, number in manifest["base"].items() if days is None or day in days]
        for delta in manifest["deltas"]:
            found += [f"{delta['number']}/{day}" for day in delta["days"] if days is None or day in days]
        return found

    def _rows(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(SEGMENT, T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], whole)
        data = f"{self.path}/data"
        reader = self.spark.read.schema(whole).option("basePath", data)
        return reader.parquet(*[f"{data}/{SEGMENT}={f}".rstrip("/") for f in folders])

    def read(self, version: int | None = None, days: Sequence[str] | None = None) -> DataFrame | None:
        """The table as of a manifest, the newest by default; None before the first.

        ``days`` (folder names such as ``curve_date=2024-03-01``) are all that is opened.
        """
        made = self.manifest() if version is None else self._manifest(version)
        if made["schema"] is None:
            return None
        schema = T.StructType.fromJson(made["schema"])
        chosen = self._folders(made, None if days is None else set(days))
        return self.merge(self._rows(schema, chosen)).select(*schema.names)
