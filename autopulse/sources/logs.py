"""Append-only logs on files as stream sources: Kafka-shaped records by offset, text lines by place.

Both are Spark data sources in Python.  The driver plans offset ranges from file names, sizes and
Parquet footers; the tasks read the ranges, as Arrow batches.  Files are reached through
``pyarrow.fs`` (local, hdfs://, s3:// and gs:// paths), by the driver and by every executor.

``kafka_log`` (S5) reads a folder ``partition=<n>/`` of Parquet files with the Kafka record columns,
each file a run of rising offsets.  Options: ``path``; ``startingOffsets`` (``earliest``, ``latest`` or
JSON such as ``{"0": 23}``, where partitions not named start at the earliest); ``maxOffsetsPerTrigger``;
``maxOffsetsPerTask`` (a range is split over tasks).

``line_log`` (S6) reads text files in the order of their paths and gives each line its place: ``value``,
``seq`` (bytes of all lines before it, over all files: unique and rising), ``file`` and ``byte_offset``.
Plain text lines so have the order that per-vehicle state needs.  Options: ``path``;
``maxBytesPerTrigger`` (whole files, at least one); ``splitBytes`` (a file is split over tasks).  A new
file must come after those read before in path order, as rotated logs do; one that comes before
stops the stream instead of being skipped.

Both bounds hold per micro-batch of a running query.  A query over what is available
(``availableNow``) takes all of it in one batch, as Spark asks such a source for one end only.  After
a restart the first batch takes what is there, since Spark does not tell a source where it was.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Ship these classes by value: executors then need pyarrow only, not this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KAFKA_SCHEMA = ("key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
                "timestampType int")
LINE_SCHEMA = "value string, seq bigint, file string, byte_offset bigint"
TASK_OFFSETS = 1_000_000
SPLIT_BYTES = 64 << 20
READ_BYTES = 4 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _files(path: str) -> list[pafs.FileInfo]:
    """Visible files below ``path`` in the order of their paths."""
    store, root = _open(path)
    root = root.rstrip("/")
    found = store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted((f for f in found if f.type == pafs.FileType.File and f.size and not any(
        part[0] in "_." for part in f.path[len(root) + 1:].split("/"))), key=lambda f: f.path)


# --- S5 ----------------------------------------------------------------------------------------

class OffsetRange(InputPartition):
    def __init__(self, partition: int, start: int, end: int, files: list[str]) -> None:
        self.partition, self.start, self.end, self.files = partition, start, end, files


class KafkaLogReader(DataSourceStreamReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.starting = options.get("startingOffsets", "latest")
        self.most = int(options.get("maxOffsetsPerTrigger", 0))
        self.per_task = int(options.get("maxOffsetsPerTask", TASK_OFFSETS))
        self.spans: dict[str, tuple[int, int]] = {}  # file -> first and last offset, from its footer
        self.position: dict[str, int] | None = None

    def _log(self) -> dict[str, list[tuple[int, int, str]]]:
        """Per partition its files as (first offset, last offset, path), rising."""
        store, _ = _open(self.path)
        out: dict[str, list[tuple[int, int, str]]] = {}
        for f in _files(self.path):
            part = next((p[10:] for p in f.path.split("/") if p.startswith("partition=")), None)
            if part is None or not f.path.endswith(".parquet"):
                continue
            if f.path not in self.spans:
                meta = pq.read_metadata(f.path, filesystem=store)
                column = meta.schema.names.index("offset")
                stats = [meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)]
                if not stats:
                    continue
                if any(s is None or not s.has_min_max for s in stats):
                    raise ValueError(f"{f.path} has no statistics of its offsets")
                self.spans[f.path] = (min(s.min for s in stats), max(s.max for s in stats))
            out.setdefault(part, []).append((*self.spans[f.path], f.path))
        return {p: sorted(files) for p, files in out.items()}

    def initialOffset(self) -> dict:
        log = self._log()
        earliest = {p: files[0][0] for p, files in log.items()}
        if self.starting == "earliest":
            return earliest
        if self.starting == "latest":
            return {p: max(last for _, last, _ in files) + 1 for p, files in log.items()}
        return earliest | {str(p): int(o) for p, o in json.loads(self.starting).items()}

    def latestOffset(self) -> dict:
        log = self._log()
        end = {p: max(last for _, last, _ in files) + 1 for p, files in log.items()}
        if self.most and self.position is not None:
            begin = {p: self.position.get(p, log[p][0][0]) for p in end}
            waiting = {p: max(0, end[p] - begin[p]) for p in end}
            total = sum(waiting.values())
            if total > self.most:  # a share of the bound by what waits, one record at least
                end = {p: begin[p] + min(w, max(1, self.most * w // total)) if w else begin[p] for p, w in waiting.items()}
        if self.position:
            end = {p: max(o, self.position.get(p, 0)) for p, o in end.items()} | {
                p: o for p, o in self.position.items() if p not in end}
        self.position = end
        return end

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        log = self._log()
        self.position = {p: max(o, (self.position or {}).get(p, 0)) for p, o in end.items()}
        out: list[InputPartition] = []
        for p, last in sorted(end.items()):
            files = log.get(p, [])
            first = start.get(p, files[0][0] if files else last)
            if first < last and (not files or files[0][0] > first and str(p) in start):
                raise ValueError(f"offsets {first} to {last} of partition {p} are no longer there")
            for lo in range(first, last, self.per_task):
                hi = min(last, lo + self.per_task)
                held = [f for a, b, f in files if a < hi and b >= lo]
                if held:
                    out.append(OffsetRange(int(p), lo, hi, held))
        return out

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        offset = ds.field("offset")
        names = ["key", "value", "topic", "offset", "timestamp", "timestampType"]
        table = ds.dataset(partition.files, format="parquet", filesystem=store)
        wanted = (offset >= partition.start) & (offset < partition.end)
        for batch in table.to_batches(columns=names, filter=wanted):
            if batch.num_rows:
                part = pa.array([partition.partition] * batch.num_rows, pa.int32())
                stamp = batch.column("timestamp").cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("value"), batch.column("topic"), part, batch.column("offset"),
                     stamp, batch.column("timestampType")],
                    names=["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"])


class KafkaLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "kafka_log"

    def schema(self) -> str:
        return KAFKA_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return KafkaLogReader(self.options)


# --- S6 ----------------------------------------------------------------------------------------

class LineRange(InputPartition):
    def __init__(self, file: str, start: int, end: int, before: int) -> None:
        self.file, self.start, self.end, self.before = file, start, end, before


class LineLogReader(DataSourceStreamReader):
    """Offsets name the last file read, the files and the bytes up to its end."""

    def __init__(self, options) -> None:
        self.path = options["path"]
        self.most = int(options.get("maxBytesPerTrigger", 0))
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.position: dict | None = None

    def initialOffset(self) -> dict:
        self.position = {"file": "", "files": 0, "bytes": 0}
        return self.position

    def latestOffset(self) -> dict:
        files = _files(self.path)
        at = self.position or {"file": "", "files": 0, "bytes": 0}
        n, size = at["files"], at["bytes"]
        self._check(files, at)
        taken = 0
        for f in files[n:]:
            if self.most and self.position is not None and taken and taken + f.size > self.most:
                break
            taken += f.size
            n += 1
        self.position = {"file": files[n - 1].path, "files": n, "bytes": size + taken} if n else at
        return self.position

    @staticmethod
    def _check(files: list, at: dict) -> None:
        if at["files"] and bisect_right([f.path for f in files], at["file"]) != at["files"]:
            raise ValueError(f"a file came or went among the {at['files']} files up to {at['file']}")

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = _files(self.path)
        self._check(files, end)
        self.position = max(self.position or end, end, key=lambda at: at["files"])
        out: list[InputPartition] = []
        before = start["bytes"]
        for f in files[start["files"]: end["files"]]:
            out += [LineRange(f.path, lo, min(f.size, lo + self.split), before) for lo in range(0, f.size, self.split)]
            before += f.size
        if before != end["bytes"]:
            raise ValueError(f"files up to {end['file']} have changed their sizes")
        return out

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        """The lines that begin inside the range; the last one may end behind it."""
        store, _ = _open(self.path)
        with store.open_input_file(partition.file) as stream:
            at = partition.start
            if at:  # the line that the byte before belongs to is the range before's
                stream.seek(at - 1)
                at -= 1
                rest, at = _after_line(stream, at)
            else:
                rest = b""
            while at < partition.end:
                data = rest + stream.read(READ_BYTES)
                more = len(data) > len(rest)
                cut = data.rfind(b"\n") + 1 if more else len(data)
                lines, rest = data[:cut], data[cut:]
                texts, places = [], []
                for line in _lines(lines):
                    if at >= partition.end:
                        break
                    texts.append(line.rstrip(b"\n").removesuffix(b"\r").decode("utf-8", "replace"))
                    places.append(at)
                    at += len(line)
                if texts:
                    offsets = pa.array(places, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(texts, pa.string()), pc.add(offsets, partition.before),
                         pa.array([partition.file] * len(texts), pa.string()), offsets],
                        names=["value", "seq", "file", "byte_offset"])
                if not more:
                    break


def _lines(data: bytes) -> list[bytes]:
    """The parts of ``data`` up to each newline, with it."""
    parts = data.split(b"\n")
    return [p + b"\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


def _after_line(stream, at: int) -> tuple[bytes, int]:
    """Skip to behind the next newline from ``at``: what was read beyond it, and its place."""
    while data := stream.read(READ_BYTES):
        cut = data.find(b"\n") + 1
        if cut:
            return data[cut:], at + cut
        at += len(data)
    return b"", sys.maxsize


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> str:
        return LINE_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LineLogReader(self.options)


def read_kafka_log(spark: SparkSession, path: str, starting_offsets: str = "latest", **options) -> DataFrame:
    """S5 on files: a stream of Kafka records with offset ranges, start positions and an admission bound."""
    spark.dataSource.register(KafkaLog)
    return spark.readStream.format("kafka_log").options(path=path, startingOffsets=starting_offsets, **options).load()


def read_line_log(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of text lines, each with its place as an order key."""
    spark.dataSource.register(LineLog)
    return spark.readStream.format("line_log").options(path=path, **options).load()


def write_kafka_log(records: DataFrame, path: str) -> None:
    """Append Kafka-shaped records as log files, offsets rising inside each file."""
    (records.repartition("partition").sortWithinPartitions("partition", "offset")
     .write.mode("append").partitionBy("partition").parquet(path))
