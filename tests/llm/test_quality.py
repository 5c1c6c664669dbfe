"""The classifier on planted junk: held-out accuracy, folds and awkward rows."""

import zlib

import numpy as np
import pytest
from llm import cases

from fleetmetrics.llm import quality


def junk(seed: int, kind: int) -> str:
    words = cases.prose(seed, 60).split(" ")
    return (" ".join(w.upper() + "!!" for w in words), " ".join(w + "%%%" for w in words), " ".join(w for w in words[:5] for _ in range(12)))[kind]


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(i, junk(i, i % 3) if i % 4 == 1 else cases.prose(i, 60)) for i in range(600)]
    labels = [(i, int(i % 4 != 1)) for i in range(600)] + [(5, 0), (9_999, 1), (None, 0)]
    return docs, cases.frame(spark, docs), cases.frame(spark, labels, "doc_id long, quality int")


def test_held_out_accuracy(spark, tables):
    rows, docs, labels = tables
    model = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    tested = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((scores[i] >= 0.7) == (i % 4 != 1) for i in tested)
    assert right / len(tested) > 0.97


def test_held_out_labels_are_not_learned(spark, tables):
    _, docs, labels = tables
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    first, second = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(first.effects, second.effects)
    assert first.bias == second.bias


def test_score_is_that_of_the_mean_vector(spark, tables):
    """Words looked up one by one give what the whole text's features give."""
    rows, docs, labels = tables
    model = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    for doc, text in rows[:40]:
        ids, counts = quality.feature_counts(text)
        total = (model.effects[ids].astype(float) * counts).sum()
        assert scores[doc] == pytest.approx(model.score(total, counts.sum()), abs=1e-5)


def test_sample_is_bounded(spark, tables):
    _, docs, labels = tables
    assert quality.train(docs, labels, sample=40).effects.any()


def test_awkward_rows(spark, tables):
    _, docs, labels = tables
    model = quality.train(docs, labels)
    odd = cases.with_clashes(cases.frame(spark, cases.awkward_texts()))
    made = quality.scored(odd.drop("score"), model, keep=["doc_id", "text", "found"]).collect()
    assert len(made) == len(cases.awkward_texts())
    empty = {r.score for r in made if not (r.text or "").strip()}
    assert len(empty) == 1
    assert all(0 <= r.score <= 1 for r in made)


def test_without_labels_or_documents(spark, tables):
    _, docs, labels = tables
    model = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.scored(docs, model).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).collect() == []


def test_a_full_cache_changes_nothing(spark, tables, monkeypatch):
    rows, docs, labels = tables
    model = quality.train(docs, labels)
    texts = [t for _, t in rows[:200]]
    want = list(quality.Scorer(model).scores(texts))
    monkeypatch.setattr(quality, "CACHE", 100)
    assert list(quality.Scorer(model).scores(texts)) == want


def test_of_a_repeated_id_the_smallest_text_is_learned(spark, tables):
    rows, docs, labels = tables
    again = [(i, t + " ~~ later") for i, t in rows[:200]] + [(3, None)]
    first = quality.train(docs, labels)
    for mixed in (rows + again, again[::-1] + rows):
        model = quality.train(cases.frame(spark, mixed).repartition(5), labels)
        assert np.array_equal(model.effects, first.effects)
        assert model.bias == first.bias
