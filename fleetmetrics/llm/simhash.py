"""Near duplicates by SimHash: block keys find candidates, bit counts decide.

Each text gets a 64-bit fingerprint. Fingerprints that differ in at most
`radius` bits are linked, and linked texts form groups. The fingerprint is cut
into blocks; two close ones agree on all but `radius` blocks, so they meet
under at least one choice of that many blocks. A bucket of such a key with more
than BUCKET distinct fingerprints is not paired: its members meet instead at
fingerprints half way between them, which is exact too and linear.

Nulls and texts without words have fingerprint 0 and are linked like any other.
Repeated rows and ties share their fingerprint and group. A null id takes no
part in the choice of a group's smallest id. `keep_one` keeps one row of each
group: that of the smallest id, a null id after all others, and of rows with
one id any one.
"""

from collections.abc import Sequence
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.common import blobs, free_name, map_column, stored

WORDS = 3
RADIUS = 2
BUCKET = 64
SEED = 42
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Signed 64-bit SimHash of the word shingles of a UTF-8 text."""
    found = text.translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    after = list(accumulate(len(w) + 1 for w in found))
    width = min(words, len(found))
    starts = [0, *after]
    ends = after[width - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends, strict=False)]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        octets = np.array(hashes[at : at + CHUNK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", words: int = WORDS, keep: Sequence[str] = ("doc_id",), into: str = "fp"
) -> DataFrame:
    """`keep` and the fingerprint as a signed long."""

    def made(column: pa.Array):
        return ((fingerprint(b, words),) for b in blobs(column))

    return map_column(docs, text, [T.StructField(into, T.LongType())], made, keep)


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def key_masks(radius: int, blocks: int) -> list[int]:
    """One mask for each choice of `blocks - radius` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [signed(sum(chosen)) for chosen in combinations(block, blocks - radius)]


def flips(most: int) -> list[int]:
    """Masks of at most `most` bits, none included."""
    return [signed(sum(1 << i for i in c)) for n in range(most + 1) for c in combinations(range(64), n)]


def _exploded(masks: list[int], operation) -> Column:
    return F.explode(F.transform(F.array(*[F.lit(m) for m in masks]), operation))


def close_pairs(fps: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """Links (a, b) of distinct fingerprints (fp): a path of links joins any two within `radius`.

    Pairs of small buckets are complete; in large ones each member is linked to
    the smallest that shares a midpoint with it.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even: midpoints lie half way")
    masks = key_masks(radius, blocks or radius + 2)
    tables = F.array(*[F.lit(m) for m in masks])
    keyed = fps.select("fp", F.posexplode(tables).alias("part", "mask")).select(
        "part", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp"
    )
    bucket = ["part", "key"]
    sizes = keyed.groupBy(*bucket).agg(F.count("*").alias("members")).filter("members > 1")
    small, large = sizes.filter(F.col("members") <= BUCKET), sizes.filter(F.col("members") > BUCKET)
    paired = keyed.join(small, bucket, "left_semi")
    left, right = paired.withColumnRenamed("fp", "a"), paired.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    direct = left.join(right, bucket).filter((F.col("a") < F.col("b")) & near)

    crowded = keyed.join(large, bucket, "left_semi").select("fp").distinct()
    midpoints = crowded.select(
        "fp", _exploded(flips(radius // 2), lambda m: m.bitwiseXOR(F.col("fp"))).alias("midpoint")
    )
    # At most one member for each flip meets at a midpoint.
    met = midpoints.groupBy("midpoint").agg(F.collect_set("fp").alias("fps")).filter("size(fps) > 1")
    starred = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b")
    return direct.select("a", "b").union(starred).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for each node of the pairs (a, b); root is the smallest node it reaches.

    Alternates two steps that hang nodes under smaller neighbours until every
    edge leads to a root. Each round is written; only a count and a checksum
    come to the driver.
    """
    edges = stored(pairs.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = both.join(least, "a").filter("b > a").select("b", F.least("a", "least").alias("root"))
        down = large.distinct().select(F.greatest("b", "root").alias("a"), F.least("b", "root").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        hung = least.select("a", F.col("least").alias("b"))
        edges = stored(small.union(hung).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())


def groups(nodes: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(node, root) for each of the distinct fingerprints (node) that is linked to another."""
    return components(close_pairs(nodes.select(F.col("node").alias("fp")), radius, blocks))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
    blocks: int | None = None,
) -> DataFrame:
    """doc_id, fp and component_id, the smallest id of the document's group; a row per document."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = stored(fingerprints(own, words=words), "fingerprints")
    distinct = marked.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("first"))
    roots = groups(distinct, radius, blocks)
    grouped = roots.join(distinct, "node")
    least = grouped.groupBy("root").agg(F.min("first").alias("least"))
    labels = distinct.join(grouped.join(least, "root").select("node", "least"), "node", "left")
    # Stored, so that both sides of the last join are dealt anew and a frequent
    # fingerprint's rows can be split.
    labels = stored(labels.select(F.col("node").alias("fp"), F.coalesce("least", "first").alias("component_id")), "labels")
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
    blocks: int | None = None,
) -> DataFrame:
    """One row of each group, with the columns of the documents."""
    row, fp = free_name(docs, "__row"), free_name(docs, "__fp")
    # Rows are numbered by being stored.
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    marked = stored(fingerprints(numbered, text, words, numbered.columns, fp), "marked")
    own = F.col(f"`{doc_id}`")
    order = F.struct(own.isNull().alias("none"), own.alias("id"), F.col(row).alias("row"))
    first = marked.groupBy(F.col(fp).alias("node")).agg(F.min(order).alias("first"))
    first = stored(first, "first")
    led = first.join(groups(first, radius, blocks), "node", "left")
    kept = led.groupBy(F.coalesce("root", "node").alias("group")).agg(F.min("first").alias("first"))
    kept = stored(kept.select(F.col("first.row").alias(row)), "kept")
    return marked.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
