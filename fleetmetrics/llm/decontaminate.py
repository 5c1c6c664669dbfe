"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Items and documents become words: A-Z in lower case, runs of digits, letters
and characters beyond ASCII. Every `window` consecutive words of an item are a
pattern, and so is a whole shorter item. The automaton reads a document's words
once and gives the words that lie in a pattern, which are mapped back to
positions in the original text.

The automaton is built in each worker from the items, which are collected in
blocks of at most MAX_CHARS characters: one block for any usual benchmark, and
one pass for each further block.

Null and wordless texts have no words and no hits; null and wordless items no
patterns. Items that share an id count once, and items without an id make hits
but are not listed.
"""

import hashlib
import re
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.common import blobs, free_name, held, map_column, stored

WINDOW = 13
SHARE = 20
MAX_CHARS = 1_000_000
_KEPT = {*range(48, 58), *range(97, 123), *range(128, 256)}
_LOWERED = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
FOLD = bytes(b if b in _KEPT else 32 for b in _LOWERED)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

RANGES = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("runs", RANGES),
        T.StructField("spans", RANGES),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Scanner:
    """The automaton over item windows; its letters are word numbers, 0 for other words."""

    def __init__(self, items: Sequence[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            words = words_of((text or "").encode())
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            width = min(window, len(ids))
            for at in range(len(ids) - width + 1) if ids else ():
                owners.setdefault(tuple(ids[at : at + width]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, names in owners.items():
            self.automaton.add_word(pattern, (len(pattern), names))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def runs(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Runs [first, past] of hit words, and the items whose windows occur."""
        if self.empty or not words:
            return [], set()
        number = self.numbers.get
        found: list[list[int]] = []
        items: set[str | None] = set()
        for last, (width, names) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            first = last + 1 - width
            while found and found[-1][0] >= first:
                found.pop()
            if found and found[-1][1] > first:
                found[-1][1] = last + 1
            else:
                found.append([first, last + 1])
            items |= names
        return found, items - {None}


def scanner(items: Sequence[tuple[str | None, str]], window: int, digest: str) -> Scanner:
    """The worker's automaton, built once for each set of items."""
    return held(("decontaminate", digest), lambda: Scanner(items, window))


def original_spans(text: bytes, runs: list[list[int]]) -> list[tuple[int, int]]:
    """Code points [start, end) in the original text of runs of words."""
    if not runs:
        return []
    words = [m.span() for m in WORD.finditer(text.decode())]
    return [(words[first][0], words[past - 1][1]) for first, past in runs]


def _scan(docs: DataFrame, items: list[tuple[str | None, str]], text: str, window: int, keep, into: str) -> DataFrame:
    digest = hashlib.sha256(repr((items, window)).encode()).hexdigest()

    def made(column: pa.Array) -> Iterator[tuple[dict]]:
        find = scanner(items, window, digest)
        for blob in blobs(column):
            words = words_of(blob)
            runs, names = find.runs(words)
            hit = sum(past - first for first, past in runs)
            yield (
                {
                    "n_words": len(words),
                    "n_hit": hit,
                    "items": sorted(names),
                    "runs": [{"start": a, "end": b} for a, b in runs],
                    "spans": [{"start": a, "end": b} for a, b in original_spans(blob, runs)],
                },
            )

    return map_column(docs, text, [T.StructField(into, FOUND)], made, keep)


def item_blocks(benchmark: DataFrame, item_id: str, text: str, most: int) -> tuple[int, Iterator[list]]:
    """How many lists of about `most` characters the items fill, one at least, and the lists."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // most))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    rows = (items.filter(block == at).collect() for at in range(blocks))
    return blocks, (sorted(((r.item, r.text) for r in part), key=repr) for part in rows)


def _combined(parts: list[Column]) -> Column:
    """One result of the results for several lists of items; spans may overlap."""
    if len(parts) == 1:
        return parts[0]
    runs = F.array_sort(F.flatten(F.array(*[p["runs"] for p in parts])))
    none = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("reach"))
    past = lambda s, r: F.greatest(s["reach"], r["start"])
    hit = F.aggregate(
        runs,
        none,
        lambda s, r: F.struct(
            (s["hit"] + F.greatest(F.lit(0), r["end"] - past(s, r))).alias("hit"),
            F.greatest(s["reach"], r["end"]).alias("reach"),
        ),
    )
    return F.struct(
        parts[0]["n_words"].alias("n_words"),
        hit["hit"].alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[p["items"] for p in parts])))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[p["spans"] for p in parts])))).alias("spans"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    into: str = "found",
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """`keep` and a struct `into`: n_words, n_hit, items (ids as sorted strings), spans
    (code points of the original text) and contaminated. A row per document."""
    own = free_name(docs, "__text")
    frame = docs.select(F.col(f"`{text}`").alias(own), *[F.col(f"`{c}`") for c in keep])
    names: list[str] = []
    count, blocks = item_blocks(benchmark, item_id, item_text, max_chars)
    for items in blocks:
        name = free_name(frame, f"__found{len(names)}")
        last = len(names) == count - 1
        frame = _scan(frame, items, own, window, [*keep, *names, *([] if last else [own])], name)
        names.append(name)
        frame = frame if last else stored(frame, "scanned")
    found = _combined([F.col(n) for n in names])
    words, hit = found["n_words"], found["n_hit"]
    judged = F.struct(
        words.alias("n_words"),
        hit.alias("n_hit"),
        found["items"].alias("items"),
        found["spans"].alias("spans"),
        ((hit > 0) & (SHARE * hit >= words)).alias("contaminated"),
    )
    return frame.select(*[F.col(f"`{c}`") for c in keep], judged.alias(into))
