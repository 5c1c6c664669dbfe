"""Token sequences of fixed windows by best-fit decreasing.

Documents become token ids with an end id after each. A document longer than a
window is first cut into full windows, each a sequence of its own; what is left
of each document is a tail. Tails are dealt by a hash over partitions and, in
blocks of at most BLOCK, taken from longest to shortest: each goes to the open
window with the least room that still holds it, which a segment tree over the
remaining capacities finds. What the last windows of a block lack stays open as
padding.

Null texts count as empty and hold the end id alone. Equal rows are packed
separately. Token ids depend on the text only, so documents keep their pieces
when a task is repeated; sequence ids are unique, not consecutive.
"""

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from fleetmetrics.llm.common import held, map_batches, ship, shuffle_partitions, stored

WINDOW = 2048
END = 1
BLOCK = 1 << 18
CACHE = 1 << 20
GROUP = 1 << 22
LONGS = ("start", "length", "ids_crc32", "doc_tokens")


def joined(offsets: pa.Array, values: pa.Array) -> pa.Array:
    """The values of each list, one after the other, as one value."""
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), b"")


class WordTokens:
    """Token ids of texts, as little-endian 32-bit bytes, from words seen before.

    The tokenizer drops white space, cuts the rest into words of letters, single
    digits and runs of other signs, and never joins what it has cut. A text's
    ids are therefore those of its parts between white space, and a part's ids
    those of its words. Arrow splits texts, cuts the different parts of a group
    of texts and puts ids together; the different words of a group are looked up,
    and only new ones are encoded. A part with signs outside PLAIN, which another
    Unicode table might class, compose or lower-case otherwise, or that may hold a
    special token, is encoded as it is. A tokenizer of another kind is refused.
    """

    # How the tokenizer normalises and cuts text, and the mark that
    # its last token of a word carries.
    NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    WORD = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    LAST = "</w>"
    # Signs that all Unicode tables agree on: ASCII, composed Latin letters that
    # lower-case to one letter, basic Cyrillic, dashes and quotation marks.
    PLAIN = r"\x00-\x7f\u00c0-\u012f\u0131-\u024f\u0410-\u044f\u2010-\u201f"
    PLAIN_WORD = re.compile(f"[{PLAIN}]*")
    # For Arrow: what makes a part be encoded as it is, and the words that are no runs of letters.
    ODD = "[^" + re.sub(r"\\[xu](\w+)", r"\\x{\1}", PLAIN) + r"]|<\|"
    SIGNS = WORD.replace("[\\p{L}]+|", "").replace("\\s", r"\t-\r ")

    def __init__(self, path: str):
        self.check(path)
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.LAST)]] = True
        # The same model for words that are normalised and cut already.
        self.model = Tokenizer(self.tokenizer.model)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), level])
        self.words: dict[str, bytes] = {"": b""}

    def check(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        steps = (found.get("normalizer") or {}).get("normalizers")
        split, *level = (found.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        words = split.get("pattern") == {"Regex": self.WORD} and split.get("behavior") == "Removed" and split.get("invert")
        words = words and len(level) == 1 and self.BYTES.items() <= level[0].items()
        marked = found["model"].get("end_of_word_suffix") == self.LAST
        special = all("<|" in t["content"] and not t["lstrip"] and not t["rstrip"] for t in found.get("added_tokens", []))
        if steps != self.NORMALIZER or not words or not marked or not special:
            raise ValueError(f"{path}: not a tokenizer of words with marked ends")

    @staticmethod
    def ids(tokenizer: Tokenizer, text: str) -> np.ndarray:
        # Without offsets, which nobody asks for.
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def learn(self, new: Iterable[str]) -> None:
        """Many plain words are put in one text: their ids end at the tokens that end words."""
        plain, single = [], []
        for word in new:
            (plain if self.PLAIN_WORD.fullmatch(word) and "<|" not in word else single).append(word)
        for at in range(0, len(plain), 200):
            some = plain[at : at + 200]
            ids = self.ids(self.model, " ".join(some))
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            if len(ends) == len(some):
                for word, start, end in zip(some, [0, *ends], ends, strict=False):
                    self.words[word] = raw[start:end]
            else:
                single += some
        for word in single:
            self.words[word] = self.ids(self.tokenizer, word).tobytes()

    def word_ids(self, column: pa.Array) -> pa.Array:
        """Ids of different words, and of parts that are encoded as they are."""
        words = column.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.words.get, words))
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        if new:
            if len(self.words) + len(new) > CACHE:
                self.words, new = {"": b""}, [w for w in words if w]
            self.learn(new)
            found = list(map(self.words.__getitem__, words))
        return pa.array(found, pa.binary())

    def part_ids(self, parts: pa.Array) -> pa.Array:
        """Ids of different parts without white space."""
        cut = pc.replace_substring_regex(pc.utf8_lower(parts), self.SIGNS, r" \0 ")
        words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(parts, self.ODD), parts, cut))
        coded = words.flatten().dictionary_encode()
        return joined(words.offsets, self.word_ids(coded.dictionary).take(coded.indices))

    def text_ids(self, column: pa.Array) -> pa.Array:
        """Ids of each text; null is empty."""
        parts = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        coded = parts.flatten().dictionary_encode()
        return joined(parts.offsets, self.part_ids(coded.dictionary).take(coded.indices))

    def encode(self, batch: Sequence[str]) -> Iterator[bytes]:
        column = pa.array(batch, pa.string())
        for start, end in groups(column):
            yield from self.text_ids(column.slice(start, end - start)).to_pylist()


def groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and end of neighbouring texts of about GROUP bytes together; longer ones are alone or last."""
    passed = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // GROUP
    bounds = [0, *(np.flatnonzero(np.diff(passed)) + 1).tolist(), len(column)]
    return pairwise(bounds) if len(column) else iter(())


def encoder(path: str) -> WordTokens:
    """The worker's encoder, whose caches are kept between batches."""
    return held(("packing", path), lambda: WordTokens(path))


def tokenized(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, with_ids: bool = True
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids.

    Python gives each document's ids, the end id added, as one value; full windows
    and the tail are cut from it here.
    """
    end = pa.scalar(np.uint32(END).tobytes())
    apart = pa.scalar(b"")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in groups(batch.column("text")):
                part = batch.slice(at, to - at)
                ids = encoder(tokenizer).text_ids(part.column("text"))
                ended = pc.binary_join_element_wise(ids, end, apart)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ended], names=["doc_id", "all"])
                pa.default_memory_pool().release_unused()

    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    whole = map_batches(own, made, T.StructType([own.schema["doc_id"], T.StructField("all", T.BinaryType())]))
    tokens = (F.octet_length("all") / 4).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), tokens - 1, F.lit(window).cast("long"))

    def piece(start: Column) -> Column:
        cut = F.substring(F.col("all"), (4 * start + 1).cast("int"), F.lit(4 * window))
        return F.struct(start.alias("start"), cut.alias("ids"))

    cut = whole.select("doc_id", tokens.alias("doc_tokens"), F.explode(F.transform(starts, piece)).alias("p"))
    length = (F.octet_length("p.ids") / 4).cast("long").alias("length")
    found = cut.select("doc_id", "p.start", length, F.crc32("p.ids").alias("ids_crc32"), "doc_tokens", "p.ids")
    return found if with_ids else found.drop("ids")


class Capacities:
    """A segment tree over remaining capacities 0 to `window`; a leaf counts open windows."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The least capacity of at least `need` that a window has."""
        count, at = self.count, need + self.leaves
        if count[at]:
            return need
        while at > 1:
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit(lengths: Iterable[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; lengths must not increase."""
    tree = Capacities(window)
    open_windows: list[list[int]] = [[] for _ in range(window + 1)]
    numbers, offsets, made = [], [], 0
    for length in lengths:
        room = tree.tightest(length)
        if room is None:
            room, number, made = window, made, made + 1
        else:
            number = open_windows[room].pop()
            tree.add(room, -1)
        numbers.append(number)
        offsets.append(window - room)
        if room > length:
            open_windows[room - length].append(number)
            tree.add(room - length, 1)
    return numbers, offsets


def _packed(frames: Iterator[pd.DataFrame], window: int, block: int) -> Iterator[pd.DataFrame]:
    """The rows of a partition with numbers of windows that count on from block to block."""
    held: list[pd.DataFrame] = []
    made = 0

    def close() -> pd.DataFrame:
        nonlocal made, held
        rows = pd.concat(held, ignore_index=True)
        held = []
        rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable", ignore_index=True)
        numbers, offsets = best_fit(rows["length"].tolist(), window)
        rows["number"] = np.array(numbers, dtype=np.int64) + made
        rows["offset"] = np.array(offsets, dtype=np.int64)
        made += max(numbers) + 1
        return rows

    for frame in frames:
        while len(frame):
            room = block - sum(map(len, held))
            held.append(frame.iloc[:room])
            frame = frame.iloc[room:]
            if len(frame):
                yield close()
    if held:
        yield close()


def pack(cut: DataFrame, window: int = WINDOW, partitions: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, LONGS, piece (if there), sequence_id and offset of the pieces. `cut` should
    be a stored table: it is read twice."""
    narrow = cut.select("doc_id", *LONGS, *[c for c in cut.columns if c == "piece"])
    tails = narrow.filter(F.col("length") < window)
    # No task gathers more than about a block of tails.
    n = partitions or max(shuffle_partitions(cut.sparkSession), -(-tails.count() // block))
    dealt = tails.repartition(n, F.xxhash64("doc_id", "start", "ids_crc32"))
    dealt = dealt.sortWithinPartitions(F.xxhash64("ids_crc32", "doc_id"), "doc_id", "start", "length")
    dealt = dealt.withColumn("part", F.spark_partition_id().cast("long"))
    schema = T.StructType([*dealt.schema.fields, *[T.StructField(c, T.LongType()) for c in ("number", "offset")]])
    ship(cut.sparkSession)
    packed = dealt.mapInPandas(lambda frames: _packed(frames, window, block), schema)
    # Odd ids for full windows, even ones for packed windows.
    number = F.shiftleft("part", 32).bitwiseOR(F.col("number"))
    packed = packed.withColumn("sequence_id", 2 * number)
    whole = narrow.filter(F.col("length") == window)
    whole = whole.withColumns(
        {"sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("long")}
    )
    return whole.unionByName(packed.select(*whole.columns))


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, with_ids: bool = True, partitions: int | None = None, **names
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for,
    ids (little-endian 32-bit); a row per piece.

    Ids are joined to the plan at the end by the number of the piece: packing itself
    moves only lengths.
    """
    cut = tokenized(docs, tokenizer, window=window, with_ids=with_ids, **names)
    if not with_ids:
        return pack(stored(cut, "pieces"), window, partitions)
    # Numbers are fixed by being stored.
    cut = stored(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    return pack(cut, window, partitions).join(cut.select("piece", "ids"), "piece").drop("piece")
