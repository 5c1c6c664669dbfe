"""Gradients by differences, scores by hand, and training that helps."""

import numpy as np
import pytest
from llm import cases

from fleetmetrics.llm import masked_lm


def sample():
    known = masked_lm.Vocabulary([b"the", b"an", b"or"])
    return masked_lm.windows(known, [t.encode() for t in (cases.prose(1, 40), "", cases.prose(2, 30))])


def test_windows_do_not_cross_texts():
    known = masked_lm.Vocabulary([b"a", b"b", b"c"])
    tokens, around, sizes = masked_lm.windows(known, [b"A b c", b"", b"b"])
    assert tokens.tolist() == [1, 2, 3, 2]
    assert around.T.tolist() == [[0, 0, 2, 3], [0, 1, 3, 0], [1, 2, 0, 0], [0, 0, 0, 0]]
    assert sizes.tolist() == [3, 0, 1]


def test_the_token_itself_is_masked():
    weights, (tokens, around, _) = masked_lm.initial(), sample()
    before = masked_lm.hidden(weights, around)
    changed = tokens.copy()
    changed[5] = 77
    assert np.array_equal(before, masked_lm.hidden(weights, around))
    assert masked_lm.log_probabilities(weights, changed, around)[5] != masked_lm.log_probabilities(weights, tokens, around)[5]


def test_probabilities_sum_to_one():
    weights, (_, around, _) = masked_lm.initial(), sample()
    one = np.repeat(around[:, 7:8], masked_lm.TOKENS, axis=1)
    every = np.arange(masked_lm.TOKENS, dtype=np.int16)
    assert np.exp(masked_lm.log_probabilities(weights, every, one)).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_are_slopes():
    weights, (tokens, around, _) = masked_lm.initial(), sample()
    weights = {n: w.astype(np.float64) for n, w in weights.items()}
    slopes = masked_lm.gradients(weights, tokens, around)
    random = np.random.default_rng(1)
    for name, slope in slopes.items():
        for flat in random.choice(np.flatnonzero(np.abs(slope) > 1e-6), 4):
            at = np.unravel_index(flat, slope.shape)
            losses = []
            for step in (1e-4, -1e-4):
                moved = {n: w.copy() for n, w in weights.items()}
                moved[name][at] += step
                losses.append(-masked_lm.log_probabilities(moved, tokens, around).mean())
            assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(slope[at], rel=1e-2, abs=1e-6)


def test_flat_and_shaped_are_inverse():
    weights = masked_lm.initial()
    again = masked_lm.shaped(masked_lm.flat(weights))
    assert all(np.array_equal(weights[n], again[n]) for n in weights)


def test_vocabulary_counts_all_documents(spark):
    docs = cases.frame(spark, [(1, "b B b a"), (2, "a c\ta"), (3, None)])
    assert masked_lm.vocabulary(docs, words=2) == [b"a", b"b"]


def test_training_prefers_the_corpus_order(spark):
    sentence = "the cat sat on the mat and the dog lay by the door".split()
    rows = [(i, " ".join(sentence * 30)) for i in range(80)]
    docs = cases.frame(spark, rows)
    words = masked_lm.vocabulary(docs)
    weights = masked_lm.train(docs, words)
    shuffled = np.random.default_rng(3).permutation(sentence * 30)
    tested = cases.frame(spark, [(1, " ".join(sentence * 30)), (2, " ".join(shuffled))])
    plain, trained = ({r.doc_id: r.mean_log_likelihood for r in masked_lm.scored(tested, words, w).collect()} for w in (masked_lm.initial(), weights))
    assert trained[1] > plain[1] + 0.5
    assert trained[1] > trained[2] + 0.1


def test_scores_are_sums_of_log_probabilities(spark):
    rows = cases.awkward_texts()
    docs = cases.with_clashes(cases.frame(spark, rows))
    words, weights = masked_lm.vocabulary(docs), masked_lm.initial()
    made = masked_lm.scored(docs, words, weights, keep=["doc_id", "text"]).collect()
    assert len(made) == len(rows)
    for r in made:
        tokens, around, _ = masked_lm.windows(masked_lm.Vocabulary(words), [(r.text or "").encode()])
        assert r.n_tokens == len(tokens)
        assert r.log_likelihood == pytest.approx(masked_lm.log_probabilities(weights, tokens, around).sum(), rel=1e-4)
        assert (r.mean_log_likelihood is None) == (len(tokens) == 0)


def test_empty_table(spark):
    assert masked_lm.pseudo_likelihood(cases.frame(spark, [])).collect() == []
