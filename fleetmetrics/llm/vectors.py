"""Sums of vectors that map tasks have gathered, one total for each key."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetmetrics.llm.common import map_batches, shuffle_partitions

TOTAL = T.StructType([T.StructField("key", T.StringType()), T.StructField("total", T.BinaryType())])
#: Keys that a task holds before it hands on what it has.
KEYS = 256


class Sums:
    """Element-wise sums of 64-bit vectors by key; whole numbers, so their order does not matter."""

    def __init__(self):
        self.total: dict[str, np.ndarray] = {}

    def add(self, key: str, vector: np.ndarray) -> None:
        if key in self.total:
            self.total[key] += vector
        else:
            self.total[key] = vector.astype(np.int64)

    def full(self) -> bool:
        return len(self.total) >= KEYS

    def emptied(self) -> pa.RecordBatch:
        keys, vectors = list(self.total), [v.astype("<i8").tobytes() for v in self.total.values()]
        self.total = {}
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(vectors, pa.binary())], names=TOTAL.names)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = Sums()
    for batch in batches:
        for key, total in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums.add(key, np.frombuffer(total.as_buffer(), dtype="<i8"))
            if sums.full():
                yield sums.emptied()
    if sums.total:
        yield sums.emptied()


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each key of rows sorted by key."""
    sums = Sums()
    for batch in batches:
        for key, total in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if sums.total and key not in sums.total:
                yield sums.emptied()
            sums.add(key, np.frombuffer(total.as_buffer(), dtype="<i8"))
    if sums.total:
        yield sums.emptied()


def summed(partial: DataFrame) -> DataFrame:
    """One row (key, total) for each key: rows are added up within partitions that hold any
    key, and then by key, where each of those has left a row or few."""
    n = shuffle_partitions(partial.sparkSession)
    spread = map_batches(partial.repartition(n, "key", "total"), _combined, TOTAL)
    return map_batches(spread.repartition(n, "key").sortWithinPartitions("key"), _by_key, TOTAL)


def vector(total: bytes) -> np.ndarray:
    return np.frombuffer(total, dtype="<i8")
