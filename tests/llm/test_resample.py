"""Importance resampling against the definition in plain Python, any run length and part size."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm import cases
from pyspark.sql import functions as F

from fleetmetrics.llm import resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, run, buckets):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    found = [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(f.encode()) % buckets for f in found]


def model(docs, targets, run=1, buckets=10_000, seed=2024, least=20, percent=10):
    own = [(i, *features(t, run, buckets)) for i, t in docs]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in targets for b in features(x, run, buckets)[1])
    sums = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (sums[0] + buckets) / ((s[b] + 1) * (sums[1] + buckets))))

    rows = []
    for i, n, found in own:
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, n, len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return rows


@pytest.mark.parametrize("run", [1, 2, 3])
def test_equals_the_model(spark, run):
    docs = [(i, cases.prose(i % 170, 5 + 7 * (i % 13)) + " É x9'Y") for i in range(300)] + cases.awkward_texts()
    targets = [cases.prose(500 + i, 30) for i in range(20)] + [None, ""]
    frame = cases.with_clashes(cases.frame(spark, docs)).withColumns({"row": F.lit(1), "part": F.lit(2), "features": F.lit(3)})
    aim = cases.frame(spark, [(i, t) for i, t in enumerate(targets)], "item_id long, text string")
    made = resample.resample(frame, aim, run=run, buckets=500, percent=30).collect()
    wanted = model(docs, targets, run, 500, percent=30)
    assert sorted(map(repr, map(tuple, made))) == sorted(map(repr, map(tuple, wanted)))


@pytest.mark.parametrize("limit", [1, 5, 40])
@pytest.mark.parametrize("run", [1, 3])
def test_part_size_changes_nothing(monkeypatch, limit, run):
    text = cases.prose(8, 60) + "  - 7x " + "é" * 50 + " end"
    wanted = features(text, run, 97)
    monkeypatch.setattr(resample, "CHARACTERS", limit)
    monkeypatch.setattr(resample.parts, "__defaults__", (limit,))
    monkeypatch.setattr(resample, "CACHE", 5)
    count, found = resample.Splitter(run, 97).buckets_of(text)
    assert (count, sorted(found.tolist())) == (wanted[0], sorted(wanted[1]))


def test_ranks_split_ties_over_tasks(spark):
    """One score and one id for a third of the rows: every rank once, and no task with all."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"), F.lit(7).alias("score"), F.col("id").alias("row"))
    made = resample.ranked(rows.repartition(8), ["doc_id", "row"])
    found = made.orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 3001))
    assert [(r.doc_id, r.row) for r in found] == sorted((r.doc_id, r.row) for r in found)


def test_without_documents_or_targets(spark):
    docs = cases.frame(spark, [(i, cases.prose(i, 30)) for i in range(40)])
    none = cases.frame(spark, [], "item_id long, text string")
    assert resample.resample(docs.limit(0), none).collect() == []
    made = resample.resample(docs, none).collect()
    assert sorted(map(tuple, made), key=repr) == sorted(map(tuple, model([(r.doc_id, r.text) for r in docs.collect()], [])), key=repr)


def test_gains_are_floored():
    assert resample.gains(np.array([0, 3]), np.array([1, 0])).tolist() == [math.floor(1000 * math.log(2 * 5 / (1 * 3))), math.floor(1000 * math.log(1 * 5 / (4 * 3)))]
