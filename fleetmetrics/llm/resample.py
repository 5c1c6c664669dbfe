"""Target-distribution importance resampling over hashed words.

Texts and targets are cut into words by a tokenizer's regular-expression split,
which is not trained and gives each word with its offsets in the lower-cased
text. A window of one to RUN neighbouring offset pairs is a feature: its words,
joined by a space, whose CRC-32 names one of BUCKETS buckets. A bucket's gain
compares its share among the targets with that among all documents, in
thousandths of a natural logarithm; a document's weight is the floored mean of
its features' gains. Weight plus a Gumbel number from a hash of the id is its
score, and the highest scores are drawn: importance sampling without replacement.

Every text is split once: the buckets of its features are written, and both the
histogram and the weights come from there. Ranks are counted over ranges of the
sorted scores, so that no task holds all drawn rows, and equal scores or ids can
be split.

Null and empty texts have no features and weight 0. Documents of fewer than
LEAST words are never drawn. Equal rows are drawn by themselves, each with a
rank of its own; a null id is hashed as no digits at all, and comes before all
other ids among equal scores. Without targets all gains follow from T = 0.
"""

import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from fleetmetrics.llm import vectors
from fleetmetrics.llm.common import held, map_batches, map_column, stored

#: The characters of a word, and those between words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
RUN = 1
BUCKETS = 10_000
SEED = 2024
LEAST = 20
PERCENT = 10
LOWER = {c: c + 32 for c in range(65, 91)}
#: Characters of a text that are split at once, and words remembered.
CHARACTERS = 1 << 20
CACHE = 1 << 19


def parts(text: str, limit: int = CHARACTERS) -> Iterator[str]:
    """The lower-cased text in parts that end between words; a word is never cut."""
    start = 0
    while len(text) - start > limit:
        gap = BETWEEN.search(text, start + limit)
        if not gap:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:]


class Splitter:
    """Buckets of the features of texts, words seen before looked up."""

    def __init__(self, run: int, buckets: int):
        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.run, self.buckets = run, buckets
        self.known: dict[str, int] = {}

    def bucket(self, feature: str) -> int:
        if feature not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[feature] = zlib.crc32(feature.encode("utf-8", "replace")) % self.buckets
        return self.known[feature]

    def features(self, text: str, words: Sequence[tuple[int, int]], fresh: int) -> Iterator[int]:
        """Buckets of the windows of offset pairs that end in one of the last `fresh`."""
        for at in range(len(words) - fresh, len(words)):
            for first in range(max(0, at - self.run + 1), at + 1):
                yield self.bucket(" ".join([text[a:b] for a, b in words[first : at + 1]]))

    def buckets_of(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words, and the features' buckets."""
        lowered = text.translate(LOWER) if text else ""
        count, found, carried = 0, [], []
        for part in parts(lowered):
            words = self.split.pre_tokenize_str(part)
            count += len(words)
            if self.run == 1:
                get, bucket = self.known.get, self.bucket
                own = [(b if (b := get(w)) is not None else bucket(w)) for w, _ in words]
            else:
                # Words carried over from the part before, for windows across the edge.
                lead = "".join(f"{w} " for w in carried)
                edges = [(a + len(lead), b + len(lead)) for _, (a, b) in words]
                ends = list(accumulate((len(w) + 1 for w in carried), initial=0))
                pairs = [(a, b - 1) for a, b in zip(ends, ends[1:], strict=False)] + edges
                joined = lead + part
                own = list(self.features(joined, pairs, len(words)))
                carried = [joined[a:b] for a, b in pairs[max(0, len(pairs) - self.run + 1) :]]
            found.append(np.array(own, dtype="<u4"))
        return count, np.concatenate(found)


def splitter(run: int, buckets: int) -> Splitter:
    return held(("resample", run, buckets), lambda: Splitter(run, buckets))


def _wide(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def featured(docs: DataFrame, keep: Sequence[str], text: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """`keep`, n_words, and features: the buckets of all features, 16 bits each or 32."""
    kind = _wide(buckets)

    def made(column: pa.Array) -> Iterator[tuple[int, bytes]]:
        for value in column.to_pylist():
            count, found = splitter(run, buckets).buckets_of(value)
            yield count, found.astype(kind).tobytes()

    return map_column(docs, text, [T.StructField("n_words", T.LongType()), T.StructField("features", T.BinaryType())], made, keep)


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs; one row comes to the driver."""
    kind = _wide(buckets)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = vectors.Sums()
        for batch in batches:
            for value in batch.column(0):
                if value.is_valid and len(value.as_buffer()):
                    sums.add("", np.bincount(np.frombuffer(value.as_buffer(), dtype=kind), minlength=buckets))
        if sums.total:
            yield sums.emptied()

    row = vectors.summed(map_batches(features.select("features"), counted, vectors.TOTAL)).first()
    return vectors.vector(row.total) if row else np.zeros(buckets, dtype=np.int64)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed shares' ratio, floored."""
    n = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(features: DataFrame, gain: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """`keep`, n_words, n_features and weight, the floored mean of the features' gains."""
    kind = _wide(len(gain))

    def made(column: pa.Array) -> Iterator[tuple[int, int]]:
        for value in column:
            own = np.frombuffer(value.as_buffer(), dtype=kind)
            yield len(own), int(gain[own].sum()) // len(own) if len(own) else 0

    fields = [T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())]
    return map_column(features, "features", fields, made, [*keep, "n_words"])


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A number of the standard Gumbel distribution in thousandths, by the id's hash."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, by: Sequence[str], label: str = "ranked") -> DataFrame:
    """The rows with `rank`, 1, 2, 3 ... by the score from high to low, then the columns `by`.

    Rows are sorted by sampled ranges and written with their range's number; a
    range's first rank is the number of rows before it, so a task sees its own
    range only.
    """
    order = [F.col("score").desc(), *[F.col(c).asc() for c in by]]
    dealt = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), label)
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    # A row for each range.
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("long")
    numbered = dealt.withColumn("inside", inside).join(F.broadcast(before), "part")
    return numbered.withColumn("rank", F.col("before") + F.col("inside")).drop("part", "inside", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least: int = LEAST,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null if not drawn), a row per document."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    aim = target.select(F.col(f"`{target_text}`").cast("string").alias("text"))
    features = stored(featured(own, ["doc_id"], "text", run, buckets), "features")
    gain = gains(histogram(features, buckets), histogram(featured(aim, [], "text", run, buckets), buckets))
    scored = weighed(features, gain, ["doc_id"]).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")

    able = F.col("n_words") >= least
    wanted = scored.filter(able).count() * percent // 100
    # Scores are whole thousandths between bounds that hold for any input: few distinct ones.
    above = scored.filter(able).groupBy("score").agg(F.count("*").alias("n"))
    above = above.withColumn("before", F.sum("n").over(Window.orderBy(F.col("score").desc())) - F.col("n"))
    least_score = above.filter(F.col("before") < wanted).agg(F.min("score")).first()[0]
    drawn = able & (F.col("score") >= F.lit(least_score)) if least_score is not None else F.lit(False)
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    shown = ["doc_id", "n_words", "n_features", "weight", "score"]
    best = ranked(scored.filter(drawn), ["doc_id", "row"]).select(*shown, rank)
    rest = scored.filter(~drawn).select(*shown, F.lit(None).cast("long").alias("rank"))
    return best.unionByName(rest)
