"""An append-only message log as a source that can be read again from any offset.

A log is a folder of partitions, a partition a folder of segments in the order
of their names, a segment a file with one message per line. Only a partition's
newest segment may still grow; a line without its end there is not yet a message.
An offset holds, for each partition, a segment and a byte in it, so it stays as
small as the number of partitions, and the same two offsets always give the same
messages. Spark's file source, in contrast, takes a file whole, once.

Files are opened with ``pyarrow.fs``: the folder has to be one that all
executors reach, mounted or by an address that library knows.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from fleetmetrics.session import ship

FORMAT = "message_log"
SCHEMA = "value binary, partition string, segment string, position long"
BLOCK = 1 << 20
SPLIT = 1 << 25


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", folder))
    return system, path.rstrip("/")


def _segments(folder: str) -> dict[str, list[tuple[str, int]]]:
    """Names and sizes of each partition's segments, oldest first; hidden names are drafts."""
    system, path = _opened(folder)
    found: dict[str, list[tuple[str, int]]] = {}
    for info in system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
        partition, _, segment = info.path[len(path) :].strip("/").rpartition("/")
        if info.is_file and partition and segment[0] not in "_.":
            found.setdefault(partition, []).append((segment, info.size))
    return {partition: sorted(found[partition]) for partition in sorted(found)}


def _last_end(file: pa.NativeFile, size: int) -> int:
    """The byte after the last line end."""
    stop = size
    while stop:
        start = max(0, stop - BLOCK)
        file.seek(start)
        at = file.read(stop - start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        stop = start
    return 0


def _next_end(file: pa.NativeFile, start: int, size: int) -> int:
    """The byte after the first line end from ``start`` on, or ``size``."""
    file.seek(start)
    while start < size:
        block = file.read(min(BLOCK, size - start))
        at = block.find(b"\n")
        if at >= 0:
            return start + at + 1
        start += len(block)
    return size


def _lines(file: pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, list[bytes]]]:
    """Whole lines between two line starts, a block at a time, with the first one's byte."""
    file.seek(start)
    at, held = start, []
    while at < stop:
        block = file.read(min(BLOCK, stop - at))
        if not block:
            raise EOFError("a segment is shorter than its offset says")
        at += len(block)
        cut = len(block) if at == stop else block.rfind(b"\n") + 1
        held.append(block[:cut] if cut else block)
        if cut:
            whole = b"".join(held)
            held = [block[cut:]]
            yield start, whole.removesuffix(b"\n").split(b"\n")
            start += len(whole)


@dataclass
class LogRange(InputPartition):
    """Messages that start in [start, stop) of a segment; its messages lie in [low, high)."""

    partition: str
    segment: str
    low: int
    high: int
    start: int
    stop: int


class _Log:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.split = int(options.get("splitBytes", SPLIT))

    def ends(self) -> dict[str, list]:
        """Offset after the last complete message. Of the newest segments only the ends are read."""
        system, path = _opened(self.folder)
        found = {}
        for partition, segments in _segments(self.folder).items():
            name, size = segments[-1]
            with system.open_input_file(f"{path}/{partition}/{name}") as file:
                found[partition] = [name, _last_end(file, size)]
        return found

    def ranges(self, start: dict[str, list], end: dict[str, list]) -> list[LogRange]:
        """Byte ranges of at most ``splitBytes``, so a busy partition is read by many tasks."""
        segments, made = _segments(self.folder), []
        for partition, (last, stop) in end.items():
            first, low = start.get(partition, ("", 0))
            there = [s for s in segments.get(partition, []) if first <= s[0] <= last]
            names = [name for name, _ in there]
            if last not in names or (first and first not in names):
                raise ValueError(f"{self.folder}/{partition}: segments between the offsets are gone")
            for name, size in there:
                begin, high = (low if name == first else 0), (stop if name == last else size)
                for at in range(begin, high, self.split):
                    made.append(LogRange(partition, name, begin, high, at, min(at + self.split, high)))
        return made

    def messages(self, part: LogRange) -> Iterator[pa.RecordBatch]:
        system, path = _opened(self.folder)
        with system.open_input_file(f"{path}/{part.partition}/{part.segment}") as file:
            start, stop = (
                at if at in (part.low, part.high) else _next_end(file, at - 1, part.high) for at in (part.start, part.stop)
            )
            for first, lines in _lines(file, start, stop):
                before = np.cumsum([0, *[len(line) + 1 for line in lines[:-1]]], dtype=np.int64)
                columns = [
                    pa.array(lines, pa.binary()),
                    pa.repeat(part.partition, len(lines)),
                    pa.repeat(part.segment, len(lines)),
                    pa.array(first + before),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["value", "partition", "segment", "position"])


class LogReader(DataSourceReader):
    def __init__(self, log: _Log):
        self.log = log

    def partitions(self) -> list[LogRange]:
        return self.log.ranges({}, self.log.ends())

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return self.log.messages(partition)


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, log: _Log):
        self.log = log

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.log.ends()

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        return self.log.ranges(start, end)

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return self.log.messages(partition)

    def commit(self, end: dict) -> None:
        """Nothing is removed: a log is shared by its readers."""


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(_Log(self.options))

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(_Log(self.options))


def log_stream(spark: SparkSession, folder: str, split_bytes: int = SPLIT) -> DataFrame:
    """The messages of a log as a stream that goes on where its checkpoint stopped."""
    spark.dataSource.register(MessageLog)
    ship(spark)
    return spark.readStream.format(FORMAT).option("splitBytes", split_bytes).load(folder)


def log_messages(spark: SparkSession, folder: str, split_bytes: int = SPLIT) -> DataFrame:
    """All complete messages that are in a log now."""
    spark.dataSource.register(MessageLog)
    ship(spark)
    return spark.read.format(FORMAT).option("splitBytes", split_bytes).load(folder)


def append_segment(messages: DataFrame, folder: str, number: int, value: str = "value") -> DataFrame:
    """Add a closed segment of this number to the log's partitions, one for each task.

    A file gets its name when it is complete, and a repeated task replaces what
    it wrote before. Null is an empty message; one with a line end is refused.
    Returns what was written: partition, segment, messages.
    """
    segment = f"{number:019d}"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(folder)
        context = TaskContext.get()
        partition, count = f"{context.partitionId():05d}", 0
        target = f"{path}/{partition}/{segment}"
        draft = f"{path}/{partition}/_{segment}-{context.taskAttemptId()}"
        system.create_dir(f"{path}/{partition}", recursive=True)
        with system.open_output_stream(draft) as file:
            for batch in batches:
                lines = [line or b"" for line in batch.column(0).to_pylist()]
                if any(b"\n" in line for line in lines):
                    raise ValueError("a message of a log cannot hold a line end")
                file.write(b"".join([line + b"\n" for line in lines]))
                count += len(lines)
        system.move(draft, target)
        yield pa.RecordBatch.from_pydict({"partition": [partition], "segment": [segment], "messages": [count]})

    spark = messages.sparkSession
    ship(spark)
    sent = messages.select(F.col(value).cast("string").cast("binary").alias("value"))
    rows = sent.mapInArrow(written, "partition string, segment string, messages long").collect()
    return spark.createDataFrame(rows, "partition string, segment string, messages long")
