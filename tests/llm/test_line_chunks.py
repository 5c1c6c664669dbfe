"""Repeated passages against a dictionary of stretches and against the passages planted."""

import random

import pytest
from llm import cases

from fleetmetrics.llm import line_chunks


def stretches(text):
    """Of each anchor the stretches to the right and to the left: lines, bytes, size."""
    own = line_chunks.Lines(text.encode())
    for number, (a, b) in enumerate(own.anchors()):
        low, high = own.reach(a, b)
        for end in range(b, high + 1):
            yield number, 1, own.body(a, b), own.body(a, end), (own.filled[a], own.filled[end - 1] + 1)
        for start in range(low, a):
            yield number, -1, own.body(a, b), own.body(start, b), (own.filled[start], own.filled[b - 1] + 1)


def expected(rows):
    """Every stretch that an earlier place has too, merged and judged by its words."""
    order = sorted({(doc is None, doc or 0, text or "") for doc, text in rows})
    first, gone = {}, {}
    for document in order:
        for number, side, anchor, body, span in stretches(document[2]):
            head = first.setdefault((side, anchor, body), (document, number))
            if head != (document, number):
                gone.setdefault(document, []).append(span)
    cleaned = []
    for doc, text in rows:
        spans = gone.get((doc is None, doc or 0, text or ""), [])
        whole = (text or "").encode()
        spans = line_chunks.long_spans(whole.split(b"\n"), spans)
        cleaned.append((doc, line_chunks.without(whole, spans).decode() if spans else text))
    return sorted(cleaned, key=repr)


def found(frame):
    return sorted([(r.doc_id, r.text) for r in line_chunks.dedup_lines(frame).collect()], key=repr)


def mixed(seed, documents=25):
    """Texts that share lines, pairs, passages and blank lines in many ways."""
    chance = random.Random(seed)
    pool = [cases.prose(seed * 1000 + i, chance.choice([1, 3, 8, 12, 60])) for i in range(30)] + ["", "  "]
    runs = [[chance.choice(pool) for _ in range(chance.randint(2, 9))] for _ in range(8)]
    rows = []
    for doc in range(documents):
        parts = []
        for _ in range(chance.randint(0, 5)):
            parts += chance.choice(runs) if chance.random() < 0.5 else [cases.prose(chance.randrange(10**6), 9)]
        rows.append((doc, "\n".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_model(spark, seed):
    rows = mixed(seed)
    assert found(cases.frame(spark, rows)) == expected(rows)


@pytest.mark.parametrize(("lines", "words"), [(3, 20), (4, 15), (6, 10), (8, 8), (10, 6), (20, 5), (40, 5), (30, 9), (2, 30), (60, 1), (1, 60)])
def test_a_repeated_passage_goes_whole(spark, lines, words):
    """At the start, the end and between other lines; only the first holder keeps it."""
    rows, rest = [], {}
    for number, holders in enumerate((2, 30)):
        passage = [cases.prose(90_000 + 5000 * number + 70 * lines + i, words) for i in range(lines)]
        if lines > 3:
            passage.insert(2, "")
        for doc in range(100 * number, 100 * number + holders):
            own = [cases.prose(100 * doc + i, 9) for i in range(10)]
            at = doc % 11
            text = "\n".join(own[:at] + passage + own[at:])
            rows.append((doc, text))
            rest[doc] = text if doc == 100 * number else "\n".join(own)
    assert dict(found(cases.frame(spark, rows))) == rest


def test_every_window_has_an_anchor_that_does_not_shift():
    for seed in range(40):
        chance = random.Random(seed)
        passage = [cases.prose(seed * 100 + i, chance.randint(1, 25)).encode() for i in range(30)]
        plain = line_chunks.Lines(b"\n".join(passage))
        for first in range(len(passage)):
            past, held = first, 0
            while past < len(passage) and (held < line_chunks.LEAST or past < first + 2):
                held += plain.words[past]
                past += 1
            if held < line_chunks.LEAST or past < first + 2:
                continue
            assert any(first <= a and b <= past for a, b in plain.anchors())
            cut = line_chunks.Lines(b"\n".join([b"something else", *passage[first:past], b"and more"]))
            inside = {(a - 1, b - 1) for a, b in cut.anchors() if a >= 1 and b <= past - first + 1}
            assert inside & {(a - first, b - first) for a, b in plain.anchors()}


def test_every_line_stays_somewhere(spark):
    line = [cases.prose(i, 11) for i in range(9)]
    texts = [line[0:3], line[1:5], line[2:6] + line[0:2], [line[7]] * 30, line[6:9], line[0:9]]
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)] + cases.awkward_texts() + [(100 + d, t) for d, t in mixed(7)]
    made = line_chunks.dedup_lines(cases.with_clashes(cases.frame(spark, rows)).drop("lines")).collect()
    assert len(made) == len(rows)
    assert {part for r in made for part in (r.text or "").split("\n")} >= {x for _, t in rows for x in (t or "").split("\n") if x.strip()}
    assert sum(r.text is None for r in made) == sum(t is None for _, t in rows)


def test_few_words_and_unique_documents_stay(spark):
    rows = [(i, f"{cases.prose(10 + i, 12)}\nall rights\nreserved by the owner\n{cases.prose(20 + i, 12)}") for i in range(5)]
    rows += [(100 + i, "\n".join(cases.prose(5000 + 100 * i + k, 10) for k in range(12))) for i in range(10)]
    assert found(cases.frame(spark, rows)) == sorted(rows, key=repr)


def test_awkward_rows(spark):
    long = "\n".join(cases.prose(5000 + i, 8) for i in range(2000))
    rows = [*cases.awkward_texts(), (30, long), (31, long), (None, long), (32, long + "\nmore"), (33, f"{cases.prose(1, 60)}\r\n" * 3)]
    assert found(cases.with_clashes(cases.frame(spark, rows)).drop("lines")) == expected(rows)


def test_report_and_columns(spark):
    rows = mixed(4)
    docs = cases.with_clashes(cases.frame(spark, rows)).drop("lines")
    made = line_chunks.dedup_lines(docs)
    assert made.columns == [*docs.columns, "lines"]
    before = dict(rows)
    for r in made.collect():
        lost = [line for s in r.lines.spans for line in before[r.doc_id].split("\n")[s.first : s.past]]
        assert len(lost) == r.lines.removed
        kept = r.text.split("\n") if len(lost) < len(before[r.doc_id].split("\n")) else []
        assert sorted(lost + kept) == sorted(before[r.doc_id].split("\n"))


def test_empty_table(spark):
    assert found(cases.frame(spark, [])) == []
