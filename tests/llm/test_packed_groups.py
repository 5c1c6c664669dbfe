"""Texts are cut and looked up by the group, not word by word."""

import random
import re
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
from llm import cases
from tokenizers import Tokenizer

from fleetmetrics.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def arrays(made):
    return [np.frombuffer(ids, "<u4").tolist() for ids in made]


def whole(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_new_parts_of_known_words_need_no_work_word_by_word():
    chance = random.Random(2)
    words = sorted({"".join(chance.choices("abcdé", k=6)) for _ in range(300)})
    tokens = packing.WordTokens(PATH)
    list(tokens.encode([" ".join([*words, *",.;!"])]))
    texts = [" ".join(f"{a.capitalize()}{chance.choice(',.;!')}{b}" for a, b in zip(words, words[at:], strict=False)) for at in range(1, 9)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        made = list(tokens.encode(texts))
    finally:
        sys.setprofile(None)
    assert arrays(made) == whole(texts)
    assert calls < len(" ".join(texts).split()) / 4


def test_plain_signs_encode_as_the_whole():
    """Every plain sign among letters, and texts of contractions, white space of any kind, digits and odd signs."""
    chance = random.Random(3)
    plain = [chr(c) for c in range(0x2100) if re.match(f"[{packing.WordTokens.PLAIN}]", chr(c))]
    some = ["'s", "'T", "'re", "'VE", "''ll", "!'d", "</w>", "1a2", "\t", "\x0b", "\r", "\x1f", "\x85", "\xa0", " ", "\n", "<", "|>"]
    some += ["<|endoftext|>", "<|ENDOFTEXT|>", "the", "É", "İ", "Σ", "ſ", "🙂", "中文", "é", "́", "…"]
    texts = [f"{s} a{s}b {s}'s{s}" for s in plain]
    texts += ["".join(chance.choice(some if chance.random() < 0.7 else plain) for _ in range(chance.randint(1, 10))) for _ in range(5000)]
    assert arrays(packing.WordTokens(PATH).encode(texts)) == whole(texts)


def test_groups_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 300)
    texts = [t for _, t in cases.awkward_texts()]
    column = pa.array(texts, pa.string())
    bounds = list(packing.groups(column))
    assert len(bounds) > 5
    assert [i for at, to in bounds for i in range(at, to)] == list(range(len(texts)))
    assert arrays(packing.WordTokens(PATH).encode(texts)) == whole([t or "" for t in texts])
    assert list(packing.groups(column.slice(0, 0))) == []
