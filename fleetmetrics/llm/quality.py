"""Document quality by supervised subword embeddings.

Features of a text are its words (as written, between white space), their
character n-grams, and a mark for each word that repeats the one before. Every
feature is hashed to one of BUCKETS learned vectors; a text is the mean of its
features' vectors, and a softmax over two outputs gives its score. Vectors and
outputs are learned together by stochastic gradient descent in numpy.

The model is fitted on at most `sample` labelled documents (TRAIN_ROWS, chosen
by a hash of their ids), whose feature counts come to the driver; every
document is scored in full. With two outputs a feature acts on the score only
through one number, vector times difference of the outputs, so workers get one
number for each bucket.

Null and empty texts get the score of the bias alone. Labels of repeated ids
are averaged, a half counting as 0; labels without a document are ignored. Of
documents that repeat an id the smallest text is trained on. Null ids are never
trained on. With no usable labels every score is 0.5.
"""

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.common import held, map_column, texts

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (2, 3, 4)
TRAIN_ROWS = 4000
EPOCHS = 10
RATE = 20.0
SEED = 7
CACHE = 1 << 19
REPEAT = BUCKETS - 1
COUNTS = T.StructType(
    [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]
)


def word_features(word: str) -> list[int]:
    """Buckets of a word and of the n-grams of the word between marks."""
    crc, last = zlib.crc32, BUCKETS - 1
    raw = word.encode()
    found = [crc(raw) % last]
    if len(raw) == len(word):
        marked = b"<" + raw + b">"
        found += [crc(marked[i : i + n], n) % last for n in GRAMS for i in range(len(marked) - n + 1)]
    else:
        marked = f"<{word}>"
        found += [crc(marked[i : i + n].encode(), n) % last for n in GRAMS for i in range(len(marked) - n + 1)]
    return found


def repeats(words: Sequence) -> int:
    return sum(a == b for a, b in zip(words, words[1:], strict=False))


def feature_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    words = text.split()
    distinct: dict[str, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    ids, weights = [REPEAT], [repeats(words)]
    for word, times in distinct.items():
        own = word_features(word)
        ids += own
        weights += [times] * len(own)
    buckets, place = np.unique(np.array(ids, dtype=np.int32), return_inverse=True)
    counts = np.bincount(place, weights=weights).astype(np.int32)
    return buckets[counts > 0], counts[counts > 0]


@dataclass(frozen=True)
class Model:
    """What a feature adds to the log odds of label 1, before the mean; and the bias."""

    effects: np.ndarray
    bias: float

    def score(self, total: float, features: int) -> float:
        return float(1 / (1 + np.exp(-(total / max(features, 1) + self.bias))))


def fit(examples: Sequence[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Gradient descent over (buckets, counts, label), a document at a time."""
    random = np.random.default_rng(SEED)
    vectors = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    outputs = random.normal(0, 1, (2, DIMENSIONS)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    if not examples:
        return Model(vectors[:, 0], 0.0)
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for k in random.permutation(len(examples)):
            ids, counts, label = examples[k]
            share = (counts / counts.sum()).astype(np.float32)[:, None]
            step = 1 - done / steps
            done += 1
            mean = (vectors[ids] * share).sum(axis=0)
            raw = outputs @ mean + bias
            error = np.exp(raw - raw.max())
            error /= error.sum()
            error[label] -= 1
            vectors[ids] -= rate * step * share * (error @ outputs)
            outputs -= 0.1 * step * np.outer(error, mean)
            bias -= 0.1 * step * error
    return Model(vectors @ (outputs[1] - outputs[0]), float(bias[1] - bias[0]))


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "quality",
    sample: int = TRAIN_ROWS,
) -> Model:
    """A model of the labels outside the held-out fold."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label).cast("double").alias("label"))
    known = known.filter(~held_out("id") & F.col("id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("id").agg((F.avg("label") > 0.5).cast("int").alias("label"))
    # The smallest hashes: of many labels first those below a bound that twice the
    # sample is expected under, so that few are sorted.
    share = min(1.0, 2 * sample / max(known.count(), 1))
    below = F.xxhash64("id") <= F.lit(min(int((2 * share - 1) * (1 << 63)), (1 << 63) - 1))
    chosen = known.filter(below).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def made(column: pa.Array) -> Iterator[tuple[dict]]:
        for text in texts(column):
            ids, counts = feature_counts(text)
            yield ({"ids": ids, "counts": counts},)

    counted = map_column(rows, "text", [T.StructField("features", COUNTS)], made, ["id", "label"])
    found = counted.toArrow()
    examples = []
    for batch in found.to_batches():
        features = batch.column("features")
        ids, counts = features.field("ids"), features.field("counts")
        keys, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
        examples += [
            (key, ids[i].values.to_numpy(), counts[i].values.to_numpy(), label)  # views, not copies
            for i, (key, label) in enumerate(zip(keys, labels, strict=True))
            if len(ids[i])
        ]
    examples.sort(key=lambda e: e[0])
    return fit([e[1:] for e in examples])


class Scorer:
    """Scores texts; words seen before are looked up."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.total = np.zeros(1024)
        self.features = np.zeros(1024, dtype=np.int64)

    def learn(self, words: set[str]) -> None:
        if len(self.number) + len(words) > CACHE:
            self.clear()
        effects, number = self.model.effects, self.number
        while len(self.total) < len(number) + len(words):
            self.total = np.concatenate([self.total, np.zeros_like(self.total)])
            self.features = np.concatenate([self.features, np.zeros_like(self.features)])
        for word in words:
            if word not in number:
                own, at = word_features(word), len(number)
                number[word] = at
                self.total[at] = effects[own].sum(dtype=np.float64)
                self.features[at] = len(own)

    def scores(self, batch: Sequence[str]) -> Iterator[float]:
        split = [t.split() for t in batch]
        for at in range(0, len(split), 64):
            part = split[at : at + 64]
            self.learn({w for words in part for w in words})
            number, total, features = self.number, self.total, self.features
            for words in part:
                ids = np.array([number[w] for w in words], dtype=np.int64)
                again = int((ids[1:] == ids[:-1]).sum())
                added = total[ids].sum() + again * float(self.model.effects[REPEAT])
                yield self.model.score(added, int(features[ids].sum()) + again)


def scored(
    docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text", into: str = "score"
) -> DataFrame:
    """`keep` and the score of each text, 0 to 1."""

    def made(column: pa.Array) -> Iterator[tuple[float]]:
        return ((s,) for s in scorer(model).scores(texts(column)))

    return map_column(docs, text, [T.StructField(into, T.DoubleType())], made, keep)


def scorer(model: Model) -> Scorer:
    """The worker's scorer of a model, whose cache of words is kept between batches."""
    key = zlib.crc32(model.effects.tobytes(), zlib.crc32(repr(model.bias).encode()))
    return held(("quality", key), lambda: Scorer(model))
