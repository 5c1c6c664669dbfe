"""Document scores by masked pseudo-likelihood.

A network in numpy predicts each token from a window of tokens on both of its
sides, the token itself masked: position-wise embeddings are summed into a
hidden layer, and the output is a class of words and then a word of the class.
A document's score is the sum of the log-probabilities of all its tokens.

Tokens are words with A-Z in lower case. The vocabulary is the most frequent
words of all documents; other words share RARE tokens by a hash of their end, and
the probability of such a word is its token's times its own share of the token's
occurrences in the corpus. The counts behind these shares are a table of all
words, which grows with the corpus. Workers hold the shares of its HELD most
frequent words; the others are joined by word.
Training reads every document once, in ROUNDS parts chosen by a hash of the
text: in a round each task descends from the common weights over its own
documents, and the tasks' results are averaged by their numbers of tokens,
summed in two steps so that no task gathers all of them. The network has a fixed
size; word counts, training and scores cover all documents and all words.

Nulls and texts without words have no tokens, a score of 0 and no mean.
Repeated rows count as often as they occur. With no words at all every weight
stays as initialised.
"""

import zlib
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.common import SLICE, map_batches, map_column, stored

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
OFFSETS = (-2, -1, 1, 2)
PAD = 0
RARE = 64
CLASSES = 32
TOKENS = CLASSES * CLASSES
WORDS = TOKENS - RARE - 1
HIDDEN = 16
ROUNDS = 2
BATCH = 8192
RATE = 0.1
SEED = 11
PIECES = 16
TEXTS = 512
HELD = 1 << 17
FAN_IN = 256

Weights = dict[str, np.ndarray]
SHAPES = {
    "context": (len(OFFSETS), TOKENS, HIDDEN),
    "bias": (HIDDEN,),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "words": (CLASSES, HIDDEN, CLASSES),
    "word_bias": (CLASSES, CLASSES),
}


def initial() -> Weights:
    random = np.random.default_rng(SEED)
    return {n: (random.normal(0, 0.1, s) if "bias" not in n else np.zeros(s)).astype(np.float32) for n, s in SHAPES.items()}


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[n].ravel() for n in SHAPES])


def shaped(values: np.ndarray) -> Weights:
    ends = np.cumsum([np.prod(s) for s in SHAPES.values()])
    parts = np.split(values.astype(np.float32), ends[:-1])
    return {n: p.reshape(s).copy() for (n, s), p in zip(SHAPES.items(), parts, strict=True)}


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z in lower case, and each text's number of words; null has none."""
    # These kernels look at single bytes, so that texts need not be valid UTF-8.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string()).fill_null("")))
    words = lists.flatten().view(pa.binary())
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(filled)])
    sizes = np.diff(before[lists.offsets.to_numpy() - lists.offsets[0].as_py()])
    return words.filter(pa.array(filled)), sizes


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what Arrow took for one is given back before the next."""
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


class Vocabulary(dict):
    """Token numbers of frequent words; other words by a hash of their last three bytes."""

    def __init__(self, words: Sequence[bytes]):
        super().__init__({w: i + 1 for i, w in enumerate(words)})
        self.words = pa.array(words, pa.binary())

    def __missing__(self, word: bytes) -> int:
        return 1 + WORDS + zlib.crc32(word[-3:]) % RARE

    def tokens(self, words: pa.Array) -> np.ndarray:
        numbers = places(words, self.words) + 1
        other = numbers == PAD
        ends = pc.binary_slice(words.filter(pa.array(other)), -3).dictionary_encode()
        hashed = np.array([self.__missing__(end) for end in ends.dictionary.to_pylist()], dtype=np.int16)
        numbers[other] = hashed[ends.indices.to_numpy()]
        return numbers.astype(np.int16)


def places(words: pa.Array, listed: pa.Array) -> np.ndarray:
    """Where each word stands in the list, or -1."""
    return pc.index_in(words, value_set=listed).fill_null(-1).to_numpy().copy()


def surroundings(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The tokens around each token of texts of these sizes."""
    reach = max(OFFSETS)
    at = np.arange(len(tokens)) + reach * (1 + np.repeat(np.arange(len(sizes)), sizes))
    stream = np.full(len(tokens) + reach * (1 + len(sizes)), PAD, np.int16)
    stream[at] = tokens
    return np.stack([stream[at + o] for o in OFFSETS])


def windows(vocabulary: Vocabulary, texts: Sequence[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, the tokens around each, and each text's number of tokens."""
    words, sizes = words_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()))
    tokens = vocabulary.tokens(words)
    return tokens, surroundings(tokens, sizes), sizes


def log_softmax(raw: np.ndarray) -> np.ndarray:
    raw = raw - raw.max(axis=1, keepdims=True)
    raw -= np.log(np.exp(raw).sum(axis=1, keepdims=True))
    return raw


def hidden(weights: Weights, around: np.ndarray) -> np.ndarray:
    # Tokens are below TOKENS; "clip" spares the check of each.
    total = weights["context"][0].take(around[0], axis=0, mode="clip") + weights["bias"]
    for side in range(1, len(OFFSETS)):
        total += weights["context"][side].take(around[side], axis=0, mode="clip")
    return np.tanh(total, out=total)


def by_class(tokens: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the rows by class; each class that occurs, with its first and past row in that order."""
    group = (tokens // CLASSES).astype(np.int8)
    past = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
    return np.argsort(group, kind="stable"), [(c, a, b) for c, (a, b) in enumerate(pairwise([0, *past])) if b > a]


def within_class(weights: Weights, own: np.ndarray, spans: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """log_softmax over the words of each row's class."""
    raw = np.empty((len(own), CLASSES), own.dtype)
    for c, first, past in spans:
        np.matmul(own[first:past], weights["words"][c], out=raw[first:past])
        raw[first:past] += weights["word_bias"][c]
    return log_softmax(raw)


def log_probabilities(weights: Weights, tokens: np.ndarray, around: np.ndarray) -> np.ndarray:
    found = np.zeros(len(tokens))
    for at in range(0, len(tokens), BATCH):
        part = tokens[at : at + BATCH]
        every = np.arange(len(part))
        h = hidden(weights, around[:, at : at + BATCH])
        classes = log_softmax(h @ weights["classes"] + weights["class_bias"])
        logs = classes[every, part // CLASSES].astype(np.float64)
        order, spans = by_class(part)
        logs[order] += within_class(weights, h[order], spans)[every, part[order] % CLASSES]
        found[at : at + BATCH] = logs
    return found


def gradients(weights: Weights, tokens: np.ndarray, around: np.ndarray) -> Weights:
    """Of the mean negative log-probability; the context's as (side, tokens, rows) parts."""
    n = len(tokens)
    every = np.arange(n)
    h = hidden(weights, around)
    error = log_softmax(h @ weights["classes"] + weights["class_bias"])
    np.exp(error, out=error)
    error[every, tokens // CLASSES] -= 1
    error /= n
    back = error @ weights["classes"].T
    made: Weights = {
        "classes": h.T @ error,
        "class_bias": error.sum(axis=0),
        "words": np.zeros(SHAPES["words"], np.float32),
        "word_bias": np.zeros(SHAPES["word_bias"], np.float32),
    }
    order, spans = by_class(tokens)
    own = h[order]
    error = within_class(weights, own, spans)
    np.exp(error, out=error)
    error[every, tokens[order] % CLASSES] -= 1
    error /= n
    more = np.empty_like(own)
    for c, first, past in spans:
        part = error[first:past]
        made["words"][c] = own[first:past].T @ part
        made["word_bias"][c] = part.sum(axis=0)
        np.matmul(part, weights["words"][c].T, out=more[first:past])
    back[order] += more
    back *= 1 - h * h
    made["bias"] = back.sum(axis=0)
    made["context"] = np.zeros(SHAPES["context"], np.float32)
    for side in range(len(OFFSETS)):
        order = np.argsort(around[side], kind="stable")
        ranked = around[side][order]
        first = np.flatnonzero(np.diff(ranked, prepend=-1))
        made["context"][side][ranked[first]] = np.add.reduceat(back.take(order, axis=0, mode="clip"), first, axis=0)
    return made


class Descent:
    """Adagrad from given weights, a batch at a time."""

    def __init__(self, weights: Weights):
        self.weights = {n: w.copy() for n, w in weights.items()}
        self.squares = {n: np.full(w.shape, 1e-6, np.float32) for n, w in weights.items()}
        self.seen = 0

    def learn(self, tokens: np.ndarray, around: np.ndarray) -> None:
        for at in range(0, len(tokens), BATCH):
            part = tokens[at : at + BATCH]
            for name, slope in gradients(self.weights, part, around[:, at : at + BATCH]).items():
                self.squares[name] += slope * slope
                self.weights[name] -= RATE * slope / np.sqrt(self.squares[name])
            self.seen += len(part)


# -- over all documents -------------------------------------------------------


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, times and power, the logarithm of times, of all words of all documents."""
    part = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            slices = (batch.column(0).slice(at, TEXTS) for at in range(0, batch.num_rows, TEXTS))
            counts = pc.value_counts(pa.chunked_array([words_of(s)[0] for s in slices], pa.binary()))
            yield pa.RecordBatch.from_arrays(counts.flatten(), names=["word", "times"])

    counts = map_batches(docs.select(F.col(text).alias("text")), counted, part)
    total = counts.groupBy("word").agg(F.sum("times").alias("times"))
    return stored(total.withColumn("power", F.floor(F.log2("times")).cast("int")), "words")


def most_frequent(total: DataFrame, words: int = WORDS) -> list[bytes]:
    """The most frequent of the counted words, ties by bytes."""
    # Counts by powers of two tell from what count on words can be among the most
    # frequent; only those are sorted, so what reaches the driver stays small.
    least, found = 0, 0
    for row in total.groupBy("power").count().orderBy(F.desc("power")).collect():
        least, found = row.power, found + row["count"]
        if found >= words:
            break
    frequent = total.filter(F.col("power") >= least).orderBy(F.desc("times"), "word").limit(words)
    return [bytes(r.word) for r in frequent.collect()]


def vocabulary(docs: DataFrame, text: str = "text", words: int = WORDS) -> list[bytes]:
    """The most frequent words of all documents, ties by bytes."""
    return most_frequent(word_counts(docs, text), words)


def rare_shares(total: DataFrame, words: Sequence[bytes]) -> DataFrame:
    """word and share, the logarithm of its share in its token's occurrences, of all words outside `words`."""
    frequent = total.sparkSession.createDataFrame([(bytearray(w),) for w in words], "word binary")
    rare = total.join(F.broadcast(frequent), "word", "left_anti")
    token = F.crc32(F.when(F.length("word") > 3, F.substring("word", -3, 3)).otherwise(F.col("word"))) % RARE
    rare = rare.select("word", "times", token.alias("token"))
    sums = F.broadcast(rare.groupBy("token").agg(F.sum("times").alias("all")))
    return rare.join(sums, "token").select("word", F.log(F.col("times") / F.col("all")).alias("share"))


def _summed(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(v, np.float64) for v in table["sums"].to_pylist()], axis=0)
    columns = {n: [table[n][0].as_py()] for n in table.column_names if n not in ("sums", "tokens")}
    columns |= {"sums": [total.tobytes()], "tokens": [sum(table["tokens"].to_pylist())]}
    return pa.table({n: columns[n] for n in table.column_names}).cast(table.schema)


def train(docs: DataFrame, words: Sequence[bytes], text: str = "text", rounds: int = ROUNDS) -> Weights:
    """Weights after every document was read once."""
    weights = initial()
    schema = "piece int, branch int, sums binary, tokens long"
    for number in range(rounds):
        start = flat(weights)

        def trained(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            known, descent = Vocabulary(words), Descent(shaped(start))
            for batch in released(batches):
                for at in range(0, batch.num_rows, TEXTS):
                    tokens, around, _ = windows(known, batch.column(0).slice(at, TEXTS))
                    descent.learn(tokens, around)
            if descent.seen:
                parts = np.array_split(flat(descent.weights).astype(np.float64) * descent.seen, PIECES)
                branch = TaskContext.get().partitionId() // FAN_IN
                rows = [
                    {"piece": i, "branch": branch, "sums": p.tobytes(), "tokens": descent.seen} for i, p in enumerate(parts)
                ]
                wire = pa.schema([("piece", pa.int32()), ("branch", pa.int32()), ("sums", pa.binary()), ("tokens", pa.int64())])
                yield pa.RecordBatch.from_pylist(rows, wire)

        own = F.pmod(F.xxhash64(text), F.lit(rounds)) == number
        local = map_batches(docs.filter(own).select(F.col(text).alias("text")), trained, schema)
        branches = local.groupBy("piece", "branch").applyInArrow(_summed, schema)
        total = branches.groupBy("piece").applyInArrow(_summed, schema).orderBy("piece").collect()
        if total:
            weights = shaped(np.concatenate([np.frombuffer(r.sums, np.float64) / r.tokens for r in total]))
    return weights


def totalled(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each text's values."""
    sums, ends = np.concatenate([[0.0], np.cumsum(values)]), np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


SCORES = (
    T.StructField("n_tokens", T.LongType()),
    T.StructField("log_likelihood", T.DoubleType()),
    T.StructField("mean_log_likelihood", T.DoubleType()),
)


def scored(
    docs: DataFrame, words: Sequence[bytes], weights: Weights, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """`keep`, n_tokens, log_likelihood and its mean; a row per document."""

    def made(column: pa.Array) -> Iterator[tuple]:
        tokens, around, sizes = windows(Vocabulary(words), column)
        totals = totalled(log_probabilities(weights, tokens, around), sizes)
        for size, total in zip(sizes.tolist(), totals.tolist(), strict=True):
            yield (size, total, total / size if size else None)

    return map_column(docs, text, SCORES, made, keep)


def shares_held(total: DataFrame, shares: DataFrame, words: Sequence[bytes], most: int) -> dict[bytes, float]:
    """The shares of the most frequent words, 0 for those of the network's own tokens."""
    frequent = most_frequent(total, len(words) + most)[len(words) :]
    chosen = total.sparkSession.createDataFrame([(bytearray(w),) for w in frequent], "word binary")
    rows = shares.join(F.broadcast(chosen), "word").collect()
    return {bytes(r.word): r.share for r in rows} | {w: 0.0 for w in words}


def _marked(docs: DataFrame, words: Sequence[bytes], weights: Weights, shares: dict[bytes, float]) -> DataFrame:
    """row, kept, n_tokens, log_likelihood with the shares held, and the other words."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()), T.StructField("others", T.ArrayType(T.BinaryType()))]
    listed, logs = pa.array(shares.keys(), pa.binary()), np.array([*shares.values(), 0.0])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(words)
        for batch in released(batches):
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found, sizes = words_of(part.column(0))
                tokens = known.tokens(found)
                around, ends = surroundings(tokens, sizes), np.concatenate([[0], np.cumsum(sizes)])
                cuts = pairwise([*ends[:-1:SLICE], ends[-1]])
                own = np.concatenate([log_probabilities(weights, tokens[a:b], around[:, a:b]) for a, b in cuts])
                at_held = places(found, listed)  # -1, the last of `logs`, for the others
                other = at_held < 0
                bounds = np.concatenate([[0], np.cumsum(other)])[ends]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found.filter(pa.array(other)))
                columns = [*part.columns[1:], pa.array(sizes), pa.array(totalled(own + logs[at_held], sizes)), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "kept", "n_tokens", "log_likelihood", "others"])

    schema = T.StructType([*docs.select("row", "kept").schema.fields, *fields])
    return map_batches(docs.select("text", "row", "kept"), made, schema)


def pseudo_likelihood(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", held: int = HELD) -> DataFrame:
    """Scores of all documents, each word as itself, under a network trained on all of them."""
    total = word_counts(docs, text)
    words = most_frequent(total)
    shares = stored(rare_shares(total, words), "shares")
    own = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"))
    numbered = own.withColumn("row", F.monotonically_increasing_id())
    weights = train(docs, words, text)
    # Stored: its rows are used twice and keep their numbers.
    marked = stored(_marked(numbered, words, weights, shares_held(total, shares, words, held)), "marked")
    others = marked.select("row", F.explode("others").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
    added = others.join(shares, "word").groupBy("row").agg(F.sum(F.col("n") * F.col("share")).alias("added"))
    likelihood = F.col("log_likelihood") + F.coalesce("added", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, likelihood / F.col("n_tokens"))
    return marked.drop("others").join(added, "row", "left").select(
        "kept.*", "n_tokens", likelihood.alias("log_likelihood"), mean.alias("mean_log_likelihood")
    )
