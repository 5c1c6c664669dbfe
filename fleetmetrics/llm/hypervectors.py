"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of three letters is the
product of its letters' vectors, each permuted by its place (rotated by 2, 1 and
0); a text's vector is the sum over its runs. A language's prototype is the sum
of its training texts' vectors, scaled to one length, and a text gets the
language whose prototype has the largest cosine with its vector.

Letters are those of Unicode, in lower case; what stands between letters counts
as one space, and a text begins and ends with one. Texts are read whole, long
ones in parts that share two letters. All texts outside the held-out fold with a
language are learned from; sums are of whole numbers, so that neither the order
of rows nor their partitions change a prototype.

A null text, or one without letters, is `und` with score 0, and so is every text
when no language is known. Null languages and texts without letters teach
nothing; null ids are not held out, and are learned from. Of equal cosines the
first language in the order of names is taken. A score is a cosine, 0 if it is
negative. Only the prototypes come to the driver, a row for each language; more
than LANGUAGES of them are refused.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm import vectors
from fleetmetrics.llm.common import SLICE, held, map_batches, map_column
from fleetmetrics.llm.quality import held_out

UNKNOWN = "und"
DIMENSIONS = 1024
SEED = 11
#: Length to which a training text's vector is scaled before it is rounded.
SCALE = 1 << 20
LANGUAGES = 4096
#: Characters of texts, and distinct runs, that are turned into vectors at once.
CHARACTERS = 1 << 19
RUNS = 1 << 12
SPACE = 32
POINTS = 0x110000


class Encoder:
    """Sums of run vectors of texts; letters' vectors depend on the seed and the letter only."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        # By code point: 0 unknown yet, 1 no letter, else 2 and more the letter's row.
        self.row = np.zeros(POINTS, dtype=np.int32)
        self.point: list[int] = []
        # Letters' vectors, rotated by 0, 1 and 2.
        self.letters = np.zeros((3, 64, dimensions), dtype=np.int8)
        self._learn(np.array([SPACE]))

    def _learn(self, points: np.ndarray) -> None:
        for p in points.tolist():
            if p != SPACE and not chr(p).isalpha():
                self.row[p] = 1
                continue
            at = len(self.point)
            if at == self.letters.shape[1]:
                self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)], axis=1)
            bits = np.random.default_rng([self.seed, p]).integers(0, 2, self.dimensions, dtype=np.int8)
            for turn in range(3):
                self.letters[turn, at] = np.roll(2 * bits - 1, turn)
            self.point.append(p)
            self.row[p] = at + 2

    def rows(self, text: str) -> np.ndarray:
        """Numbers of the letters of a text, spaces (0) between and around them; empty without letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        found = self.row[points]
        if not found.all():
            self._learn(np.unique(points[found == 0]))
            found = self.row[points]
        found = np.concatenate([[0], np.where(found == 1, 0, found - 2), [0]])
        if not found.any():
            return found[:0]
        return found[np.concatenate([[True], (found[1:] != 0) | (found[:-1] != 0)])]

    def runs(self, rows: np.ndarray) -> np.ndarray:
        """A number for each run of three."""
        wide = rows.astype(np.int64)
        return (wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:]

    def bundled(self, keys: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
        """For each text the sum of its runs' vectors, in whole numbers."""
        total = np.zeros((texts, self.dimensions))
        place, distinct = pd.factorize(keys)
        mask = (1 << 21) - 1
        for at in range(0, len(distinct), RUNS):
            some = distinct[at : at + RUNS]
            bound = self.letters[0][some & mask] * self.letters[1][(some >> 21) & mask] * self.letters[2][some >> 42]
            inside = slice(None) if len(distinct) <= RUNS else (place >= at) & (place < at + RUNS)
            counts = np.bincount(owners[inside] * len(some) + place[inside] - at, minlength=texts * len(some))
            # Counts stay far below 2 ** 24, so that sums are exact.
            total += counts.reshape(texts, len(some)).astype(np.float32) @ bound.astype(np.float32)
        return total

    def vectors(self, texts: Sequence[str | None]) -> np.ndarray:
        """A row for each text; zeros without letters."""
        total = np.zeros((len(texts), self.dimensions))
        keys, owners, size = [], [], 0

        def close() -> None:
            nonlocal keys, owners, size
            if size:
                first, past = owners[0][0], owners[-1][0] + 1
                total[first:past] += self.bundled(np.concatenate(keys), np.concatenate(owners) - first, past - first)
            keys, owners, size = [], [], 0

        for number, text in enumerate(texts):
            rows = self.rows(text) if text else np.zeros(0, dtype=np.int64)
            for at in range(0, len(rows) - 2, CHARACTERS):
                some = self.runs(rows[at : at + CHARACTERS + 2])
                keys.append(some)
                owners.append(np.full(len(some), number))
                size += len(some)
                if size >= CHARACTERS:
                    close()
        close()
        return total


def encoder(dimensions: int, seed: int) -> Encoder:
    return held(("hypervectors", dimensions, seed), lambda: Encoder(dimensions, seed))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; rows of zeros stay."""
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length == 0, 1, length)


class Profiles:
    """Languages in the order of their names, and a prototype of length one for each."""

    def __init__(self, names: Sequence[str], prototypes: np.ndarray, seed: int = SEED):
        self.names, self.prototypes, self.seed = list(names), prototypes, seed

    def judge(self, texts: Sequence[str | None]) -> Iterator[tuple[str, float]]:
        found = encoder(self.prototypes.shape[1], self.seed).vectors(texts)
        known = found.any(axis=1)
        if not self.names:
            yield from ((UNKNOWN, 0.0) for _ in texts)
            return
        cosines = unit(found) @ self.prototypes.T
        best = cosines.argmax(axis=1)
        for ok, at, row in zip(known, best, cosines, strict=True):
            yield (self.names[at], float(min(max(row[at], 0.0), 1.0))) if ok else (UNKNOWN, 0.0)


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED
) -> Profiles:
    """Prototypes of the languages of all documents outside the held-out fold."""
    own = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    own = own.filter(~held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = vectors.Sums()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                names = np.array(part.column(0).to_pylist(), dtype=object)
                found = encoder(dimensions, seed).vectors(part.column(1).to_pylist())
                scaled = np.rint(unit(found) * SCALE).astype(np.int64)
                taught = found.any(axis=1)
                for name in sorted(set(names[taught])):
                    sums.add(name, scaled[taught & (names == name)].sum(axis=0))
                    if sums.full():
                        yield sums.emptied()
        if sums.total:
            yield sums.emptied()

    found = vectors.summed(map_batches(own, gathered, vectors.TOTAL)).limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    total = {r.key: vectors.vector(r.total) for r in found}
    names = sorted(total)
    rows = np.array([total[n] for n in names], dtype=np.float64).reshape(len(names), dimensions)
    return Profiles(names, unit(rows), seed)


def identified(
    docs: DataFrame, profiles: Profiles, keep: Sequence[str] = ("doc_id",), text: str = "text", into: Sequence[str] = ("lang_pred", "score")
) -> DataFrame:
    """`keep`, the language of each text and its score."""

    def made(column: pa.Array) -> Iterator[tuple[str, float]]:
        return profiles.judge(column.to_pylist())

    fields = [T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())]
    return map_column(docs, text, fields, made, keep)
