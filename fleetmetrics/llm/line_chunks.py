"""Repeated passages of lines, found by content-defined chunks and compared byte by byte.

A hash rolls over the hashes of two neighbouring lines (blank ones are skipped).
From each line on, the fewest lines that hold LEAST words are a window, and the
smallest rolled hash of a window is an anchor: it depends on the window's lines
only, so a passage has the same anchors wherever it stands, and every passage of
LEAST words or more in two lines or more has one. A line of LONG words is an
anchor by itself. Anchors are the boundaries of chunks of lines.

Anchors whose two lines occur more than once anywhere are the seeds. Each is
extended line by line, over LEAST words to either side, as far as the same lines
stand beside an equal anchor at an earlier place. The next anchor of a passage,
or its edge, is never further away: so a repeated passage is covered to both
edges. Extensions are found by digests of the lines, and every
stretch is compared byte by byte with the earlier one before it goes.

Stretches of a text that overlap or touch are one; it goes if it has LEAST words
in two lines that are not blank, or a line of LONG words. Each line that goes
stands at an earlier place, by document id, text hash and line: so every line
stays somewhere, and a passage stays where it occurs first.

Null and empty texts have no anchors; a null text stays null. Rows equal in id
and text count as one document and stay alike. A null id orders after all
others. White space at the ends of lines counts; the last line's missing line
end does not. Of a very long text one copy is held with its lines; what is
written for an anchor is the lines that it is extended over.
"""

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.common import SLICE, blobs, free_name, map_batches, release, stored

LONG = 50
LEAST = 20

EDGES = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("line", T.IntegerType())]))
#: An anchor with the lines beside it: where it begins in the body, and where each
#: extension to the left begins and to the right ends, in bytes and in lines.
SEED = T.StructType(
    [
        T.StructField("first", T.IntegerType()),
        T.StructField("digest", T.LongType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("past", T.IntegerType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("lefts", EDGES),
        T.StructField("rights", EDGES),
    ]
)


class Lines:
    """The lines of a text, those that are not blank, and its anchors."""

    def __init__(self, text: bytes):
        self.text = text
        self.lines = text.split(b"\n")
        self.starts = list(accumulate((len(line) + 1 for line in self.lines), initial=0))
        sizes = [len(line.split()) for line in self.lines]
        self.filled = [i for i, n in enumerate(sizes) if n]
        self.words = [sizes[i] for i in self.filled]

    def anchors(self) -> list[tuple[int, int]]:
        """[first, past) of anchors, numbers among the lines that are not blank, in order."""
        digest = xxhash.xxh3_64_intdigest
        n = len(self.filled)
        own = [digest(self.lines[i]) for i in self.filled]
        rolled = [digest(b"%d %d" % (a, b)) for a, b in zip(own, own[1:], strict=False)]
        chosen = {(i, i + 1) for i, size in enumerate(self.words) if size >= LONG}
        # The smallest hash of each window, by a queue of candidates with rising hashes.
        queue: list[int] = []
        head, past, held = 0, 0, 0
        for first in range(n - 1):
            while past < n and (held < LEAST or past < first + 2):
                held += self.words[past]
                past += 1
                if past > 1:
                    new = past - 2
                    while len(queue) > head and rolled[queue[-1]] > rolled[new]:
                        queue.pop()
                    queue.append(new)
            if held < LEAST:
                break
            while queue[head] < first:
                head += 1
            chosen.add((queue[head], queue[head] + 2))
            held -= self.words[first]
        return sorted(chosen)

    def begin(self, item: int) -> int:
        return self.starts[self.filled[item]]

    def end(self, item: int) -> int:
        """The end of a line's bytes, without its line end."""
        return self.starts[self.filled[item] + 1] - 1

    def body(self, first: int, past: int) -> bytes:
        return self.text[self.begin(first) : self.end(past - 1)]

    def reach(self, first: int, past: int) -> tuple[int, int]:
        """The lines to either side of an anchor that LEAST words begin in: the next
        anchor of a passage that holds this one is not further away, nor is its edge."""
        low, held = first, 0
        while low > 0 and held < LEAST:
            low -= 1
            held += self.words[low]
        high, held = past, 0
        while high < len(self.filled) and held < LEAST:
            held += self.words[high]
            high += 1
        return low, high

    def seeds(self, wanted: set[int] | None = None) -> Iterator[tuple]:
        """Rows of SEED, of the anchors with wanted numbers."""
        for number, (first, past) in enumerate(self.anchors()):
            if wanted is not None and number not in wanted:
                continue
            low, high = self.reach(first, past)
            zero = self.begin(low)
            lefts = [{"at": self.begin(i) - zero, "line": self.filled[i]} for i in range(first - 1, low - 1, -1)]
            rights = [{"at": self.end(i) - zero, "line": self.filled[i] + 1} for i in range(past - 1, high)]
            digest = xxhash.xxh3_64_intdigest(self.body(first, past)) - (1 << 63)
            yield (number, digest, self.body(low, high), self.begin(first) - zero, self.end(past - 1) - zero, self.filled[first], lefts, rights)


def enough(lines: Sequence[bytes]) -> bool:
    """Whether a stretch of lines is long enough to go."""
    sizes = [len(line.split()) for line in lines]
    return sum(sizes) >= LEAST and (sum(n > 0 for n in sizes) > 1 or max(sizes) >= LONG)


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap or touch made one."""
    made: list[tuple[int, int]] = []
    for first, past in spans:
        if made and first <= made[-1][1]:
            made[-1] = (made[-1][0], max(past, made[-1][1]))
        else:
            made.append((first, past))
    return made


def long_spans(lines: Sequence[bytes], spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Merged spans that are long enough."""
    return [(a, b) for a, b in merged(sorted(spans)) if enough(lines[a:b])]


def without(text: bytes, spans: Sequence[tuple[int, int]]) -> bytes:
    lines = text.split(b"\n")
    gone = {i for first, past in spans for i in range(first, past)}
    return b"\n".join(line for i, line in enumerate(lines) if i not in gone)


def _key(doc_id: str, text: str) -> Column:
    """Names a document: its id and a hash of its text."""
    own = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("-"))
    return F.concat_ws(":", own, F.hex(F.xxhash64(F.col(f"`{text}`"))))


def _places(rows: DataFrame) -> DataFrame:
    """key, first and digest of every anchor."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                owner, first, digest = [], [], []
                for row, blob in enumerate(blobs(part.column(0))):
                    text = Lines(blob)
                    for number, (a, b) in enumerate(text.anchors()):
                        owner.append(row)
                        first.append(number)
                        digest.append(xxhash.xxh3_64_intdigest(text.body(a, b)) - (1 << 63))
                key = part.column(1).take(pa.array(owner, pa.int32()))
                columns = [key, pa.array(first, pa.int32()), pa.array(np.array(digest, dtype=np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "first", "digest"])

    return map_batches(rows.select("text", "key"), made, "key string, first int, digest long")


def _seeds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, key and SEED of the wanted anchors (key, firsts)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
        edges = pa.list_(pa.struct([("at", pa.int32()), ("line", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                owner, found = [], []
                for row, (blob, firsts) in enumerate(zip(blobs(part.column(0)), part.column(1).to_pylist(), strict=True)):
                    for seed in Lines(blob).seeds(set(firsts)):
                        owner.append(row)
                        found.append(seed)
                own = [c.take(pa.array(owner, pa.int32())) for c in part.columns[2:]]
                columns = list(zip(*found, strict=True)) or [[] for _ in SEED]
                new = [pa.array(c, t) for c, t in zip(columns, [*arrow, edges, edges], strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *new], names=["id", "key", *SEED.names])

    held = rows.join(wanted.hint("merge"), "key").select("text", "firsts", "id", "key")
    return map_batches(held, made, T.StructType([*held.select("id", "key").schema.fields, *SEED.fields]))


def _cut(start: Column, end: Column) -> Column:
    return F.substring(F.col("body"), start + 1, end - start)


def repeated_stretches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key, first, past (lines) of stretches that stand at an earlier place."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), _key(doc_id, text).alias("key"), F.col(f"`{text}`").alias("text")
    )
    places = stored(_places(rows), "places")
    # Rows equal in id and text are one document, so they alone repeat nothing.
    seen = places.groupBy("digest").agg(
        F.min("key").alias("one"), F.max("key").alias("other"), F.min("first").alias("a"), F.max("first").alias("b")
    )
    many = stored(seen.filter("one <> other OR a <> b").select("digest"), "many")
    wanted = places.join(many.hint("merge"), "digest", "left_semi").groupBy("key").agg(F.collect_set("first").alias("firsts"))
    wanted = stored(wanted, "wanted")
    release(places, many)
    seeds = stored(_seeds(rows, wanted), "seeds")
    release(wanted)
    # Rows equal in id and text have given equal seeds.
    distinct = seeds.select("key", "first", "body", "at", "past", "line").dropDuplicates(["key", "first"])

    # An extension by k lines to one side, the anchor included.
    right = F.transform("rights", lambda e: F.struct(F.lit(1).alias("side"), F.xxhash64(_cut(F.col("at"), e["at"])).alias("hash"), e["at"].alias("edge"), e["line"].alias("line")))
    left = F.transform("lefts", lambda e: F.struct(F.lit(-1).alias("side"), F.xxhash64(_cut(e["at"], F.col("past"))).alias("hash"), e["at"].alias("edge"), e["line"].alias("line")))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key", "first")
    stretch = F.explode(F.concat(right, left))
    runs = seeds.select("digest", order.alias("place"), stretch.alias("s")).select("digest", "place", "s.*")
    key = ["digest", "side", "hash"]
    heads = runs.groupBy(*key).agg(F.min("place").alias("head"), F.max("place").alias("last")).filter("head <> last")
    # Stored, so that both sides are dealt anew and a frequent stretch's rows can be split.
    heads = stored(heads.select(*key, "head"), "heads")
    held = runs.join(heads.hint("merge"), key).filter("place <> head")
    # The longest on each side: the last line to the right, the first to the left.
    far = F.struct((F.col("side") * F.col("line")).alias("reach"), "line", "edge", "head")
    longest = held.groupBy("place", "side").agg(F.max(far).alias("far"))
    chosen = longest.select(F.col("place.key").alias("key"), F.col("place.first").alias("first"), "side", "far.*")

    # Byte by byte: the stretch itself against that of the earlier place, which has
    # as many bytes on the same side of its anchor.
    mine = distinct.withColumnRenamed("line", "own")
    start = F.when(F.col("side") > 0, F.col("at")).otherwise(F.col("edge"))
    end = F.when(F.col("side") > 0, F.col("edge")).otherwise(F.col("past"))
    own = chosen.join(mine.hint("merge"), ["key", "first"]).select(
        "key",
        F.when(F.col("side") > 0, F.col("own")).otherwise(F.col("line")).alias("low"),
        F.when(F.col("side") > 0, F.col("line")).alias("high"),
        "side",
        _cut(start, end).alias("stretch"),
        F.col("head.key").alias("head_key"),
        F.col("head.first").alias("head_first"),
        "first",
    )
    own = stored(own, "own")
    release(heads)
    other = distinct.select(
        F.col("key").alias("head_key"), F.col("first").alias("head_first"), F.col("body").alias("head_body"), F.col("at").alias("head_at"), F.col("past").alias("head_past")
    )
    size = F.octet_length("stretch")
    began = F.when(F.col("side") > 0, F.col("head_at")).otherwise(F.col("head_past") - size)
    same = F.substring(F.col("head_body"), began + 1, size) == F.col("stretch")
    equal = own.join(other.hint("merge"), ["head_key", "head_first"]).filter(same)
    # A stretch to the left ends with the anchor, whose end the stretch to the right tells.
    anchors = equal.groupBy("key", "first").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    found = anchors.filter("high IS NOT NULL").select("key", F.col("low").alias("first"), F.col("high").alias("past"))
    found = stored(found, "stretches")
    release(seeds, own)
    return found


def dedup_lines(
    docs: DataFrame, keep: Sequence[str] | None = None, doc_id: str = "doc_id", text: str = "text", into: str = "lines"
) -> DataFrame:
    """The columns `keep` (all by default) with the text cleaned, and a struct `into`: n_lines,
    removed (lines), chunks (stretches removed), spans (line ranges of the original text)."""
    keep = list(keep if keep is not None else docs.columns)
    key, gone = free_name(docs, "__key"), free_name(docs, "__gone")
    removed = repeated_stretches(docs, doc_id, text).groupBy(F.col("key").alias(key))
    removed = removed.agg(F.sort_array(F.collect_list(F.struct("first", "past"))).alias(gone))
    # Stored, so that both sides of the join are dealt anew.
    removed = stored(removed, "removed")
    joined = docs.withColumn(key, _key(doc_id, text)).join(removed.hint("merge"), key, "left")
    return _cleaned(joined, keep, text, gone, into)


def _cleaned(joined: DataFrame, keep: list[str], text: str, gone: str, into: str) -> DataFrame:
    """The text is cut here and not in SQL: it keeps bytes and lines as the chunks saw them."""
    fields = [f if f.name != text else T.StructField(text, T.StringType()) for f in joined.select(*[F.col(f"`{c}`") for c in keep]).schema.fields]
    span = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("past", T.IntegerType())]))
    made = T.StructType(
        [
            T.StructField("n_lines", T.LongType()),
            T.StructField("removed", T.LongType()),
            T.StructField("chunks", T.LongType()),
            T.StructField("spans", span),
        ]
    )
    arrow = pa.struct(
        [("n_lines", pa.int64()), ("removed", pa.int64()), ("chunks", pa.int64())]
        + [("spans", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())])))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                source, ranges = batch.column(0), batch.column(1).to_pylist()
                cleaned, report = [], []
                for value, spans in zip(source.cast(pa.binary()).to_pylist(), ranges, strict=True):
                    pairs = long_spans(value.split(b"\n"), [(s["first"], s["past"]) for s in spans]) if spans else []
                    cleaned.append(without(value, pairs) if pairs else value)
                    lines = value.count(b"\n") + 1 if value else 0
                    lost = sum(b - a for a, b in pairs)
                    report.append({"n_lines": lines, "removed": lost, "chunks": len(pairs), "spans": [{"first": a, "past": b} for a, b in pairs]})
                new = pa.array(cleaned, pa.binary()).cast(source.type)
                kept = [new if n == text else c for n, c in zip(keep, batch.columns[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(report, arrow)], names=[*keep, into])

    sent = joined.select(F.col(f"`{text}`").alias(free_name(joined, "__text")), F.col(gone), *[F.col(f"`{c}`") for c in keep])
    return map_batches(sent, cut, T.StructType([*fields, T.StructField(into, made)]))
