"""Pieces against whole-text encoding, windows against a plain best fit."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm import cases
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetmetrics.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, made, window):
    ids = {}
    for doc, text in rows:
        ids.setdefault(doc, []).append(whole_ids(text))
    pieces, sequences = {}, {}
    for r in made:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(ids)
    for doc, texts in ids.items():
        want = sorted(
            (s, len(t[s : s + window]), zlib.crc32(np.array(t[s : s + window], "<u4").tobytes()), len(t))
            for t in texts
            for s in range(0, len(t), window)
        )
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc]) == want
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in parts])
        assert [r.offset for r in parts] == [0, *ends[:-1]]
        assert ends[-1] <= window
    return sequences


@pytest.mark.parametrize("window", [64, 2048])
def test_awkward_rows(spark, window):
    rows = cases.awkward_texts()
    docs = cases.with_clashes(cases.frame(spark, rows))
    check(rows, packing.pack_documents(docs, PATH, window=window, with_ids=False).collect(), window)


def test_words_apart_encode_as_the_whole(spark):
    texts = ["it's  <|endoftext|> a b\tc", "é ́x", "a b c\x1fd", "İ ΑΣ ΣΑΣ, don't", cases.prose(3, 500)]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.WordTokens(PATH).encode(texts)]
    assert got == [whole_ids(t)[:-1] for t in texts]


def test_any_signs_encode_as_the_whole():
    """Ten thousand texts of signs from all of Unicode, assigned or not, with spaces and special tokens."""
    chance = random.Random(11)
    ranges = [(32, 127), (0, 0x250), (0x370, 0x600), (0x300, 0x370), (0x1E00, 0x2100), (0x2000, 0x2070), (0, 0xD800), (0xE000, 0x110000)]
    made = []
    for _ in range(10_000):
        low, high = chance.choice(ranges)
        text = "".join(chr(chance.randrange(low, high)) for _ in range(12))
        made.append(" ".join([text[:7], text[7:], *chance.choices(["<|endoftext|>", "it's", "Éa1", ""], k=chance.randint(0, 2))]))
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.WordTokens(PATH).encode(made)]
    whole = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(made, add_special_tokens=False)]
    assert sum(a != b for a, b in zip(got, whole, strict=True)) == 0


def test_another_tokenizer_is_refused():
    with pytest.raises(ValueError, match="not a tokenizer of words"):
        packing.WordTokens(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 50)
    texts = [cases.prose(i, 60) for i in range(10)]
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.WordTokens(PATH).encode(texts)]
    assert got == [whole_ids(t)[:-1] for t in texts]


def test_ids_are_joined(spark):
    rows = cases.awkward_texts()
    made = packing.pack_documents(cases.frame(spark, rows), PATH, window=128).collect()
    check(rows, made, 128)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in made)


def test_several_blocks_number_windows_apart(spark):
    rows = [(i, cases.prose(i, i % 40)) for i in range(400)]
    cut = packing.tokenized(cases.frame(spark, rows), PATH, window=64, with_ids=False).cache()
    check(rows, packing.pack(cut, 64, partitions=2, block=37).collect(), 64)


def test_empty_table(spark):
    assert packing.pack_documents(cases.frame(spark, []), PATH, with_ids=False).collect() == []


def plain_best_fit(lengths, window):
    rooms, numbers, offsets = [], [], []
    for length in lengths:
        fitting = [r for r in rooms if r >= length]
        if fitting:
            at = max(i for i, r in enumerate(rooms) if r == min(fitting))
        else:
            at = len(rooms)
            rooms.append(window)
        numbers.append(at)
        offsets.append(window - rooms[at])
        rooms[at] -= length
    return rooms, offsets


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_tightest_window(seed):
    chance = random.Random(seed)
    lengths = sorted((chance.randint(1, 64) for _ in range(300)), reverse=True)
    numbers, offsets = packing.best_fit(lengths, 64)
    rooms, want = plain_best_fit(lengths, 64)
    assert len(set(numbers)) == len(rooms)
    assert sorted(offsets) == sorted(want)


def test_little_padding(spark):
    chance = random.Random(8)
    rows = [(i, int(chance.expovariate(1 / 700)) % 2047 + 1) for i in range(4000)]
    cut = spark.createDataFrame(rows, "doc_id long, length long").withColumns(
        {"start": F.lit(0).cast("long"), "ids_crc32": F.col("doc_id"), "doc_tokens": F.col("length")}
    )
    made = packing.pack(cut, partitions=4).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    total, sequences = made.agg(F.sum("n"), F.count("*")).first()
    assert total == sum(n for _, n in rows)
    assert 1 - total / (2048 * sequences) < 0.03
