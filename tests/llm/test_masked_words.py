"""Words outside the network's vocabulary are predicted as themselves."""

import math
from collections import Counter

import pytest
from llm import cases

from fleetmetrics.llm import masked_lm


@pytest.mark.parametrize("held", [0, 7, 1000])
def test_words_of_one_token_are_told_apart(spark, monkeypatch, held):
    """A token's words get their shares of it; scores are those of the network plus the shares."""
    counts = masked_lm.word_counts
    monkeypatch.setattr(masked_lm, "most_frequent", lambda total, words=3: sorted(r.word for r in total.collect())[:words])
    rows = [*cases.awkward_texts(), (50, "often xxing often xxing xxing"), (51, "rarely yying"), (52, "rarely xxing")]
    docs = cases.with_clashes(cases.frame(spark, rows))
    words = masked_lm.most_frequent(counts(docs))
    known = masked_lm.Vocabulary(words)
    texts = [(t or "").encode().translate(masked_lm.LOWER).split() for _, t in rows]
    times = Counter(w for t in texts for w in t)
    tokens = Counter()
    for w, n in times.items():
        if w not in words:
            tokens[known[w]] += n
    share = {w: 0.0 if w in words else math.log(n / tokens[known[w]]) for w, n in times.items()}
    plain = masked_lm.scored(docs, words, masked_lm.train(docs, words), ["doc_id", "text"]).collect()
    made = masked_lm.pseudo_likelihood(docs, ["doc_id", "text"], held=held).collect()
    order = lambda r: repr((r.doc_id, r.text))
    for a, b in zip(sorted(plain, key=order), sorted(made, key=order), strict=True):
        more = sum(share[w] for w in (a.text or "").encode().translate(masked_lm.LOWER).split())
        assert b.n_tokens == a.n_tokens
        assert b.log_likelihood == pytest.approx(a.log_likelihood + more, rel=1e-4, abs=1e-3)
        assert (b.mean_log_likelihood is None) == (a.n_tokens == 0)
    by_id = {r.doc_id: r.log_likelihood for r in made}
    assert by_id[51] < by_id[52]
