"""Exact duplicates against a dictionary."""

import hashlib
import re

from llm import cases

from fleetmetrics.llm import content_sort


def expected(rows):
    groups = {}
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (doc, _), text in zip(rows, texts, strict=True):
        groups.setdefault(text, []).append(doc)
    made = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known, default=None)
        left = 1
        for doc in ids:
            kept = bool(doc == keep and left)
            left -= kept
            made.append((doc, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(made, key=repr)


def found(frame, **options):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted([tuple(r[c] for c in columns) for r in content_sort.exact_duplicates(frame, **options).collect()], key=repr)


def test_awkward_rows(spark):
    rows = cases.awkward_texts()
    assert found(cases.frame(spark, rows)) == expected(rows)
    assert found(cases.with_clashes(cases.frame(spark, rows)), partitions=3) == expected(rows)


def test_crowded_group_is_split(spark):
    rows = [(i, "the same text") for i in range(500)] + [(1000 + i, cases.prose(i, 20)) for i in range(300)]
    rows += [(i, "the same text") for i in range(5)]
    assert found(cases.frame(spark, rows), partitions=16) == expected(rows)


def test_texts_that_share_their_start(spark):
    rows = [(i, "x" * 200 + str(i % 7)) for i in range(70)]
    assert found(cases.frame(spark, rows)) == expected(rows)


def test_empty_table(spark):
    assert found(cases.frame(spark, [])) == []
