"""Topics without a broker: a data source of keyed messages with headers and offsets.

A topic is a folder of segments. A segment is one published batch: a folder named
after its first offset that holds files of JSON lines, named after their place and
their number of rows. It appears by one rename, whole, and never changes; a
message's offset is its segment's first offset plus its place, so order inside a
file is kept and offsets survive restarts. ``rows_per_second`` admits no more than
that when a stream plans its offsets, however often it is triggered.
"""

from __future__ import annotations

import base64
import io
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

NAME = "topic_log"
SCHEMA = "topic string, key string, value string, headers array<struct<key string, value binary>>, offset long, published_us long"
#: Most messages of a file: what one task reads.
ROWS_PER_FILE = 100_000


@dataclass
class Log:
    """The segments below ``root``; those seen once are not listed again, as they never change."""

    root: str
    _known: dict = field(default_factory=dict)

    def __post_init__(self):
        at = self.root if "://" in self.root or self.root.startswith("file:") else f"file://{self.root}"
        self.fs, self.at = pafs.FileSystem.from_uri(at)

    def _list(self, path: str) -> list[str]:
        return sorted(f.base_name for f in self.fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)))

    def files(self, topic: str) -> list[tuple[str, int, int]]:
        """(path, first offset, end offset) of a topic's files in order."""
        found = []
        for segment in self._list(f"{self.at}/{topic}"):
            if not segment.isdigit():
                continue
            if (topic, segment) not in self._known:
                names = [n for n in self._list(f"{self.at}/{topic}/{segment}") if n.endswith(".jsonl")]
                first, made = int(segment), []
                for name in names:
                    rows = int(name[:-6].split("-")[1])
                    made.append((f"{self.at}/{topic}/{segment}/{name}", first, first + rows))
                    first += rows
                self._known[topic, segment] = made
            found += self._known[topic, segment]
        return found

    def end(self, topic: str) -> int:
        found = self.files(topic)
        return found[-1][2] if found else 0

    def has_batch(self, topic: str, batch: str) -> bool:
        return any(f"batch-{batch}" in self._list(f"{self.at}/{topic}/{s}") for s in self._list(f"{self.at}/{topic}") if s.isdigit())


@dataclass
class _Part(InputPartition):
    topic: str
    path: str
    base: int  # offset of the file's first row
    first: int
    last: int


def _parts(log: Log, start: dict, end: dict) -> list[_Part]:
    made = []
    for topic, stop in end.items():
        begin = start.get(topic, 0)
        for path, first, last in log.files(topic):
            if first < stop and last > begin:
                made.append(_Part(topic, path, first, max(first, begin), min(last, stop)))
    return made


def _read(root: str, part: _Part) -> Iterator[tuple]:
    with Log(root).fs.open_input_stream(part.path) as stream:
        for place, line in enumerate(io.TextIOWrapper(stream, "utf-8", newline="\n"), part.base):
            if place >= part.last:
                break
            if place >= part.first:
                m = json.loads(line)
                headers = [(k, base64.b64decode(v)) for k, v in m.get("headers", [])]
                yield part.topic, m.get("key"), m.get("value"), headers, place, m["at"]


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.root, self.topics = options["path"], options["topics"].split(",")

    def partitions(self) -> list[_Part]:
        log = Log(self.root)
        return _parts(log, {}, {t: log.end(t) for t in self.topics}) or [_Part(self.topics[0], "", 0, 0, 0)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        return _read(self.root, partition) if partition.path else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, options):
        self.root, self.topics = options["path"], options["topics"].split(",")
        self.rate = float(options.get("rows_per_second", 0))
        # Offsets planned so far outlive the query here: a restart never plans behind them.
        self.plan_file = options.get("plan")
        if self.rate and not self.plan_file:
            raise ValueError("rows_per_second needs the option plan, a file of the query's own")
        self.log, self.tokens, self.seen_at = Log(self.root), self.rate, time.monotonic()

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.topics, 0)

    def _planned(self) -> dict:
        fs, path = pafs.FileSystem.from_uri(self.plan_file if "://" in self.plan_file else f"file://{self.plan_file}")
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return self.initialOffset()
        with fs.open_input_stream(path) as stream:
            return self.initialOffset() | json.loads(stream.read())

    def _plan(self, offsets: dict) -> None:
        fs, path = pafs.FileSystem.from_uri(self.plan_file if "://" in self.plan_file else f"file://{self.plan_file}")
        fs.create_dir(path.rpartition("/")[0])
        with fs.open_output_stream(f"{path}.new") as stream:
            stream.write(json.dumps(offsets).encode())
        fs.move(f"{path}.new", path)

    def latestOffset(self) -> dict:
        ends = {t: self.log.end(t) for t in self.topics}
        if not self.rate:
            return ends
        now = time.monotonic()
        self.tokens = min(self.rate, self.tokens + (now - self.seen_at) * self.rate)
        self.seen_at = now
        planned = self._planned()
        for topic in self.topics:
            step = min(int(self.tokens), max(0, ends[topic] - planned[topic]))
            planned[topic] += step
            self.tokens -= step
        self._plan(planned)
        return planned

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        return _parts(self.log, start, end) or [_Part(self.topics[0], "", 0, 0, 0)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        return _read(self.root, partition) if partition.path else iter(())


@dataclass
class _Written(WriterCommitMessage):
    files: list  # (path, rows)


class _Writer(DataSourceWriter):
    def __init__(self, options):
        self.root, self.topic, self.batch = options["path"], options["topic"], options.get("batch")
        self.pending = uuid.uuid4().hex

    def _folder(self, log: Log) -> str:
        return f"{log.at}/_pending/{self.pending}"

    def write(self, iterator) -> _Written:
        log, made, rows, out = Log(self.root), [], 0, None
        folder = self._folder(log)
        log.fs.create_dir(folder)

        def close():
            if out is not None:
                out.close()
                made.append((path, rows))

        path = None
        for row in iterator:
            if out is None or rows == ROWS_PER_FILE:
                close()
                # The name is the attempt's own; what is not committed stays behind unseen.
                path, rows = f"{folder}/{uuid.uuid4().hex}", 0
                out = log.fs.open_output_stream(path)
            headers = [[h["key"], base64.b64encode(bytes(h["value"])).decode()] for h in row["headers"] or []]
            message = {"at": time.time_ns() // 1000, "key": row["key"], "value": row["value"]} | ({"headers": headers} if headers else {})
            out.write((json.dumps(message, ensure_ascii=False) + "\n").encode())
            rows += 1
        close()
        return _Written(made)

    def commit(self, messages: list[_Written | None]) -> None:
        """Give the files their places and let the whole segment appear by one rename."""
        log = Log(self.root)
        files = [f for m in messages if m is not None for f in m.files]
        if not files or (self.batch is not None and log.has_batch(self.topic, self.batch)):
            return
        whole = f"{log.at}/_pending/{self.pending}-whole"
        log.fs.create_dir(whole)
        log.fs.create_dir(f"{log.at}/{self.topic}")
        for place, (path, rows) in enumerate(files):
            log.fs.move(path, f"{whole}/{place:06d}-{rows}.jsonl")
        if self.batch is not None:
            log.fs.open_output_stream(f"{whole}/batch-{self.batch}").close()
        for _ in range(20):  # another writer may have taken the offset
            target = f"{log.at}/{self.topic}/{log.end(self.topic):020d}"
            try:
                log.fs.move(whole, target)
                self.abort(messages)
                return
            except OSError:
                if log.fs.get_file_info(target).type == pafs.FileType.NotFound:
                    raise
        raise OSError(f"no free offset in {self.topic}")

    def abort(self, messages: list[_Written | None]) -> None:
        """Remove what tasks left of this write."""
        log = Log(self.root)
        if log.fs.get_file_info(self._folder(log)).type != pafs.FileType.NotFound:
            log.fs.delete_dir(self._folder(log))


class TopicLog(DataSource):
    """Options: path; topics (reading, comma-separated) or topic (writing); rows_per_second and plan; batch."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return _Writer(self.options)


def read_log(
    spark: SparkSession, root: str, topics: str, stream: bool = True,
    rows_per_second: float | None = None, plan: str | None = None,
) -> DataFrame:
    """Messages of ``topics`` with topic, key, value, headers, offset and published_us.

    ``rows_per_second`` throttles a stream at admission; ``plan`` then names a
    file of the query's own that keeps what was admitted.
    """
    spark.dataSource.register(TopicLog)
    reader = (spark.readStream if stream else spark.read).format(NAME).option("path", root).option("topics", topics)
    if rows_per_second:
        reader = reader.option("rows_per_second", str(rows_per_second)).option("plan", plan)
    return reader.load()


def write_log(messages: DataFrame, root: str, topic: str, batch: str | None = None) -> None:
    """Append keyed messages (key, value, headers) as one segment; a named ``batch`` is taken once."""
    messages.sparkSession.dataSource.register(TopicLog)
    writer = messages.select("key", "value", "headers").write.format(NAME).option("path", root).option("topic", topic)
    if batch is not None:
        writer = writer.option("batch", batch)
    writer.mode("append").save()
