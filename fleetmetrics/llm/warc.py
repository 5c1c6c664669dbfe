"""WARC archives: written with revisit records, and read back past damage.

Writing: of pages with equal payloads the one with the largest id becomes a
response record, the others revisit records that point at it. Each record is a
gzip member of its own. Every task writes its own files, named after the
attempt, and lists them; the list is stored by Spark, so only files of attempts
that succeeded are ever read.

Reading checks every record: gzip checksum, header, lengths, block and payload
digests. After a failed check the reader searches for the next member or
version line at which a whole valid record begins, goes on from there, and logs
the bytes in between as a gap with the reason. Memory holds one record at a
time. Plain and compressed records may follow each other in one file.

Null pages have an empty payload; a null or unprintable URL is left out or
escaped. Rows that share an id are written each; of rows with equal payloads
all with the largest id are responses, and if all ids are null all are.

The folder must be one that all executors share; it is opened with
pyarrow.fs, so it may be on a mounted disk, HDFS or an object store.
"""

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetmetrics.llm.common import map_batches, shuffle_partitions, stored

ARCHIVE_BYTES = 64 << 20
LEVEL = 6
STEP = 1 << 18
DATE = "2024-01-01T00:00:00Z"
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
LINE = re.compile(rb"WARC/1\.\d\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = re.compile(r"<urn:x-page:(-?\d+)>")
URI_SAFE = "%/:?#[]@!$&'()*+,;=~"

LISTED = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("records", T.LongType())]
)
READ = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("gap", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("uri", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The bytes of a response record, or of a revisit record if it refers to a page."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _uri(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url:
        fields.append(("WARC-Target-URI", quote(url, safe=URI_SAFE)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", PROFILE)]
    header = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields) + "\r\n"
    return header.encode() + block + b"\r\n\r\n"


# -- writing ------------------------------------------------------------------


class Archives:
    """Files of at most about `most` bytes in a folder, for one task attempt."""

    def __init__(self, folder: str, most: int):
        self.files, self.root = pyarrow.fs.FileSystem.from_uri(folder)
        self.most = most
        context = TaskContext.get()
        self.stem = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        self.done: list[dict] = []
        self.out = None

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.path = f"{self.root}/{self.stem}-{len(self.done):04d}.warc.gz"
            self.out, self.size, self.count = self.files.open_output_stream(self.path, compression=None), 0, 0
        self.out.write(data)
        self.size += len(data)
        self.count += 1
        if self.size >= self.most:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append({"path": self.path.rsplit("/", 1)[-1], "bytes": self.size, "records": self.count})


def write_warc(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """The stored list of files written: path (below the folder), bytes, records.

    Payloads under `least` bytes are always responses.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    newest = rows.filter(F.octet_length("payload") >= least).groupBy("same").agg(
        F.max("page_id").alias("newest"), F.count("*").alias("copies")
    )
    # Written first, so that both sides of the join are shuffled and the rows of a
    # very frequent payload can be split.
    several = stored(newest.filter("copies > 1").drop("copies"), "several")
    joined = rows.join(several, "same", "left")
    refers = F.when(~F.col("newest").eqNullSafe(F.col("page_id")), F.col("newest"))
    joined = joined.select("page_id", "url", "payload", refers.alias("refers_to"))
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    schema = to_arrow_schema(LISTED)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = Archives(folder, archive_bytes)
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                row = [c[i].as_py() for c in columns]
                archives.add(gzip.compress(record(*row), LEVEL, mtime=0))
        archives.close()
        yield pa.RecordBatch.from_pylist(archives.done, schema)

    return stored(map_batches(joined, written, LISTED), "archives")


# -- reading ------------------------------------------------------------------


class Damaged(Exception):
    """A failed check; its text is the reason that is logged."""


class Source:
    """Bytes of a file by position."""

    def __init__(self, file):
        self.file = file
        self.size = file.size()

    def at(self, offset: int, length: int) -> bytes:
        return self.file.read_at(max(0, min(length, self.size - offset)), offset)


def member(source: Source, offset: int) -> tuple[bytes, int]:
    """Content and length of the gzip member here."""
    inflate, parts, at, begin = zlib.decompressobj(31), [], offset, b""
    while not inflate.eof:
        chunk = source.at(at, STEP)
        if not chunk:
            raise Damaged("truncated member")
        at += len(chunk)
        try:
            parts.append(inflate.decompress(chunk))
        except zlib.error as error:
            raise Damaged("broken member") from error
        begin = (begin + parts[-1])[: len(VERSION)]
        if not VERSION.startswith(begin):
            raise Damaged("member without a version line")
    return b"".join(parts), at - len(inflate.unused_data) - offset


def header(data: bytes) -> tuple[dict[str, str], int]:
    """Fields by lower-case name, and where the block begins."""
    end = data.find(b"\r\n\r\n")
    if not LINE.match(data):
        raise Damaged("no version line")
    if end < 0:
        raise Damaged("header without an end")
    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no length")
    return fields, end + 4


def plain(source: Source, offset: int) -> tuple[bytes, int]:
    """The record here that is not compressed, and its length."""
    head, size = source.at(offset, STEP), STEP
    while LINE.match(head) and b"\r\n\r\n" not in head and len(head) == size:
        size *= 2
        head = source.at(offset, size)
    fields, begin = header(head)
    length = begin + int(fields["content-length"]) + 4
    if offset + length > source.size:
        raise Damaged("truncated record")
    return source.at(offset, length), length


def parsed(data: bytes) -> dict:
    """The record in these bytes, every check passed."""
    fields, begin = header(data)
    block = data[begin:-4]
    if len(block) != int(fields["content-length"]) or data[-4:] != b"\r\n\r\n":
        raise Damaged("wrong length")
    if fields.get("warc-block-digest", f"sha1:{sha1(block)}") != f"sha1:{sha1(block)}":
        raise Damaged("wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    if kind == "response":
        if digest not in ("", sha1(payload)):
            raise Damaged("wrong payload digest")
        digest, size = sha1(payload), len(payload)
    else:
        size = int(declared[1]) if declared else len(payload)
    ids = [ID.fullmatch(fields.get(n, "")) for n in ("warc-record-id", "warc-refers-to")]
    page_id, refers_to = (int(m[1]) if m else None for m in ids)
    return {
        "record_type": kind,
        "page_id": page_id,
        "uri": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": refers_to,
        "payload": payload if kind == "response" else None,
    }


def record_at(source: Source, offset: int) -> tuple[dict, int]:
    start = source.at(offset, len(VERSION))
    if start.startswith(GZIP):
        data, length = member(source, offset)
    elif start == VERSION:
        data, length = plain(source, offset)
    else:
        raise Damaged("neither member nor version line")
    return parsed(data), length


def starts(source: Source, offset: int) -> Iterator[int]:
    """Positions from here on where a member or a version line may begin."""
    overlap = len(VERSION) - 1
    while offset < source.size:
        chunk = source.at(offset, STEP + overlap)
        for found in re.finditer(rb"\x1f\x8b\x08|WARC/1\.", chunk):
            if found.start() < STEP:
                yield offset + found.start()
        offset += STEP


def salvage(source: Source) -> Iterator[tuple[int, int, str | None, dict]]:
    """offset, length, reason, record: records without a reason, and gaps with one."""
    offset = 0
    while offset < source.size:
        try:
            found, length = record_at(source, offset)
        except Damaged as damage:
            reason, after, found = str(damage), source.size, None
            for candidate in starts(source, offset + 1):
                try:
                    found, length = record_at(source, candidate)
                    after = candidate
                    break
                except Damaged:
                    continue
            yield offset, after - offset, reason, {}
            offset = after
            if found is None:
                return
        yield offset, length, None, found
        offset += length


def read_warc(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for each record and each gap of the listed files (column path, below the folder).

    Gaps have a reason in `gap`; use `records` and `gaps` to tell them apart.
    """
    schema = to_arrow_schema(READ)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_file(f"{root}/{path}") as file:
                    yield from _batches(path, file)

    def _batches(path: str, file) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for offset, length, gap, found in salvage(Source(file)):
            payload = found.get("payload") if with_payload else None
            rows.append({**found, "path": path, "offset": offset, "length": length, "gap": gap, "payload": payload})
            held += len(payload or b"") + 200
            if held > STEP * 16:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    dealt = files.select("path").repartition(shuffle_partitions(files.sparkSession))
    return map_batches(dealt, read, READ)


def records(read: DataFrame) -> DataFrame:
    return read.filter("gap IS NULL").drop("gap")


def gaps(read: DataFrame, columns: Sequence[str] = ("path", "offset", "length", "gap")) -> DataFrame:
    return read.filter("gap IS NOT NULL").select(*columns)
