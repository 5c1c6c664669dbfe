"""Benchmark hits against a search window by window."""

import re

import pytest
from llm import cases

from fleetmetrics.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        width = min(13, len(words))
        for i in range(len(words) - width + 1) if words else ():
            windows.setdefault(tuple(words[i : i + width]), set()).add(item)
    made = []
    for doc, text in rows:
        words = WORD.findall(lowered(text))
        hit, names = set(), set()
        for window, owners in windows.items():
            n = len(window)
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit |= set(range(i, i + n))
                    names |= owners
        names = sorted(str(n) for n in names if n is not None)
        made.append((doc, len(words), len(hit), tuple(names), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(made, key=repr)


def cut(seed, words, where):
    return " ".join(cases.prose(seed, words).split(" ")[where])


@pytest.fixture(scope="module")
def rows():
    inside = f"Before, {cut(900, 60, slice(0, 30)).upper()}!! and after {cases.prose(31, 200)}"
    return [
        *cases.awkward_texts(),
        (20, inside),
        (21, cut(900, 60, slice(0, 12))),
        (22, "tiny item here. TINY-ITEM, x tiny item"),
        (23, cut(901, 40, slice(0, 26)) + " " + cut(901, 40, slice(5, 40))),
    ]


@pytest.fixture(scope="module")
def items():
    return [(1, cases.prose(900, 60)), (2, "Tiny item"), (10, cases.prose(901, 40)), (None, "two words"), (3, None), (4, "..."), (10, "one")]


def found(spark, rows, items, **options):
    docs = cases.with_clashes(cases.frame(spark, rows))
    benchmark = cases.with_clashes(cases.frame(spark, items, "item_id long, text string"))
    made = decontaminate.contamination(docs, benchmark, **options)
    return sorted(
        [(r.doc_id, r.found.n_words, r.found.n_hit, tuple(r.found["items"]), r.found.contaminated) for r in made.collect()], key=repr
    )


def test_awkward_rows(spark, rows, items):
    assert found(spark, rows, items) == expected(rows, items)


def test_items_in_several_blocks(spark, rows, items):
    assert found(spark, rows, items, max_chars=120) == expected(rows, items)


def test_empty_tables(spark, rows):
    assert found(spark, [], [(1, "a b")]) == []
    assert found(spark, rows, []) == expected(rows, [])


def test_spans_lie_in_the_original(spark):
    text = f"Ünd vor: {cases.prose(900, 13).replace(' ', ', ')}. 🙂 Danach"
    made = decontaminate.contamination(cases.frame(spark, [(1, text)]), cases.frame(spark, [(5, cases.prose(900, 13))], "item_id long, text string"))
    span = made.first().found.spans[0]
    assert text[span.start : span.end] == cases.prose(900, 13).replace(" ", ", ")


def test_all_columns_can_be_kept(spark, rows, items):
    docs = cases.with_clashes(cases.frame(spark, rows)).drop("found")
    benchmark = cases.frame(spark, items, "item_id long, text string")
    kept = decontaminate.contamination(docs, benchmark, keep=docs.columns)
    assert kept.columns == [*docs.columns, "found"]
    assert kept.count() == len(rows)
