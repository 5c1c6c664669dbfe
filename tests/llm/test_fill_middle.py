"""Fill-in-the-middle against slices of Python texts, parts of any size, and the way back."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm import cases
from pyspark.sql import functions as F

from fleetmetrics.llm import fill_middle

ALPHABET = "ab é🙂ß\u0000<P>SM\n"


def model(doc_id, text):
    text = text or ""
    n = len(text)
    own = "" if doc_id is None else str(doc_id)
    digits = hashlib.sha256(f"1:{own}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 7, 64, 1 << 20])
def test_pieces_of_any_part_size(limit):
    chance = random.Random(limit)
    texts = ["".join(chance.choices(ALPHABET, k=chance.randint(0, 40))) for _ in range(60)] + ["", ""]
    cuts = [sorted(chance.randint(0, len(t)) for _ in range(2)) for t in texts]
    # A slice of a longer array, as batches come.
    column = pa.array(["before", *texts, "after"]).slice(1, len(texts))
    made = fill_middle.pieces(column, np.array([a for a, _ in cuts]), np.array([b for _, b in cuts]), limit)
    assert [c.to_pylist() for c in made] == [
        [t[:a] for t, (a, _) in zip(texts, cuts, strict=True)],
        [t[a:b] for t, (a, b) in zip(texts, cuts, strict=True)],
        [t[b:] for t, (_, b) in zip(texts, cuts, strict=True)],
    ]


def test_rows_equal_the_model_and_come_back(spark):
    chance = random.Random(3)
    rows = [(i, "".join(chance.choices(ALPHABET, k=chance.randint(0, 60)))) for i in range(400)]
    rows += cases.awkward_texts() + [(70, "a<P>b"), (71, "<M>"), (72, "<P<P"), (73, "<S")]
    docs = cases.frame(spark, rows)
    made = fill_middle.fill_in_middle(docs, keep=["doc_id", "text"]).select("doc_id", "text", "fim.*")
    made = made.withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    wanted = sorted(((i, *model(i, t)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=repr) == wanted
    assert all(r.again == (r.text or "") for r in made)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_no_rows_and_clashing_columns(spark):
    docs = cases.with_clashes(cases.frame(spark, cases.awkward_texts())).withColumns({c: F.lit("own") for c in ("t", "n", "low", "form", "kept", "output", "h1")})
    made = fill_middle.fill_in_middle(docs, keep=docs.columns).collect()
    assert len(made) == len(cases.awkward_texts())
    assert all(r.n == r.output == r.kept == "own" and r.fim.output is not None for r in made)
    assert fill_middle.fill_in_middle(docs.limit(0)).collect() == []


def test_settings(spark):
    docs = cases.frame(spark, [(i, "some text") for i in range(50)])
    forms = [fill_middle.fill_in_middle(docs, **o).select("fim.form").distinct().collect() for o in ({"cut_share": 0}, {"cut_share": 100, "spm_share": 100}, {"cut_share": 100, "spm_share": 0})]
    assert [[r.form for r in f] for f in forms] == [["plain"], ["spm"], ["psm"]]
