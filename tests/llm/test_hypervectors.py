"""Language profiles against the definition written out, held-out accuracy and awkward rows."""

import zlib

import numpy as np
import pytest
from llm import cases

from fleetmetrics.llm import hypervectors, vectors

TONGUES = {"aa": "bcdaeo", "bb": "bcfiuo", "cc": "äöüsch", "dd": "ждиол"}


def speech(lang: str, seed: int, words: int) -> str:
    chance = np.random.default_rng(seed)
    return " ".join("".join(chance.choice(list(TONGUES[lang]), size=chance.integers(2, 7))) for _ in range(words))


def by_hand(encoder: hypervectors.Encoder, text: str) -> np.ndarray:
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = f" {' '.join(letters.split())} "
    total = np.zeros(encoder.dimensions)
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        encoder._learn(np.array([ord(x) for x in (a, b, c) if not encoder.row[ord(x)]], dtype=int))
        own = [encoder.letters[0][encoder.row[ord(x)] - 2].astype(int) for x in (a, b, c)]
        total += np.roll(own[0], 2) * np.roll(own[1], 1) * own[2]
    return total


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, speech(lang, i, 40 + i % 7), lang) for i in range(400) for lang in [sorted(TONGUES)[i % 4]]]
    odd = [(None, speech("aa", 5000, 30), "aa"), (9001, None, "bb"), (9002, "123 !?", "cc"), (9003, speech("cc", 5001, 30), None)]
    return rows, cases.frame(spark, rows + odd, "doc_id long, text string, lang string")


def test_vectors_are_the_sums_of_runs(monkeypatch):
    monkeypatch.setattr(hypervectors, "RUNS", 50)
    monkeypatch.setattr(hypervectors, "CHARACTERS", 97)
    encoder = hypervectors.Encoder(64)
    texts = ["", None, "a", "Straße, 12 Ä", cases.prose(3, 80), "中文字 ελληνικά", " x ", "7", cases.prose(3, 80)]
    found = encoder.vectors(texts)
    for text, row in zip(texts, found, strict=True):
        wanted = by_hand(encoder, text) if any(c.isalpha() for c in text or "") else np.zeros(64)
        assert np.array_equal(row, wanted)


def test_letters_do_not_depend_on_order():
    first, second = hypervectors.Encoder(32), hypervectors.Encoder(32)
    first.vectors(["zyx"])
    assert np.array_equal(first.vectors(["abc"]), second.vectors(["abc"]))


def test_held_out_accuracy(spark, corpus):
    rows, docs = corpus
    made = {r.doc_id: r for r in hypervectors.identified(docs, hypervectors.train(docs)).collect()}
    tested = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(made[i].lang_pred == lang for i, lang in tested) / len(tested) > 0.97
    assert all(0 <= r.score <= 1 for r in made.values())
    assert [tuple(made[i])[1:] for i in (9001, 9002)] == [("und", 0.0)] * 2
    assert made[9003].lang_pred == "cc"


def test_prototypes_depend_neither_on_partitions_nor_on_held_out_rows(spark, corpus):
    _, docs = corpus
    first = hypervectors.train(docs)
    turned = docs.withColumn("lang", hypervectors.F.when(hypervectors.held_out(), "aa").otherwise(hypervectors.F.col("lang")))
    for other in (docs.repartition(7), turned):
        again = hypervectors.train(other)
        assert again.names == first.names
        assert np.array_equal(again.prototypes, first.prototypes)


def test_awkward_rows(spark, corpus):
    odd = cases.with_clashes(cases.frame(spark, cases.awkward_texts()))
    made = hypervectors.identified(odd, hypervectors.train(corpus[1]), keep=["doc_id", "text", "found"], into=("l", "s")).collect()
    assert len(made) == len(cases.awkward_texts())
    assert all((r.l == "und") == (not any(c.isalpha() for c in r.text or "")) for r in made)
    assert {r.found for r in made} == {"own found"}


def test_nothing_to_learn_and_no_rows(spark, corpus):
    _, docs = corpus
    none = hypervectors.train(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in hypervectors.identified(docs, none).collect()} == {("und", 0.0)}
    assert hypervectors.identified(docs.limit(0), hypervectors.train(docs)).collect() == []


def test_too_many_languages_are_refused(spark, corpus, monkeypatch):
    monkeypatch.setattr(hypervectors, "LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        hypervectors.train(corpus[1])


def test_sums_by_key(spark, monkeypatch):
    monkeypatch.setattr(vectors, "KEYS", 2)
    rows = [(f"k{i % 5}", np.array([i, 1], dtype="<i8").tobytes()) for i in range(200)]
    made = vectors.summed(spark.createDataFrame(rows, vectors.TOTAL).repartition(6)).collect()
    assert {r.key: vectors.vector(r.total).tolist() for r in made} == {
        f"k{k}": [sum(range(k, 200, 5)), 40] for k in range(5)
    }
    assert len(made) == 5
