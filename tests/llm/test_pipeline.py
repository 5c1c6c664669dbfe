"""The pipeline's stages on a small corpus with planted cases, and its contract."""

import pytest
from llm import cases
from llm.test_quality import junk
from llm.test_simhash import model_groups, model_print
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from fleetmetrics.llm.common import stored
from fleetmetrics.session import scratch_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark):
    """A folder of tables, and the planted ids."""
    clean = {i: "\n".join(cases.prose(100 * i + k, 30) for k in range(6)) for i in range(120)}
    passage = "\n".join(cases.prose(90_000 + k, 15) for k in range(8))
    planted = {
        "junk": {1000 + i: "\n".join(junk(2000 + 3 * i + k, k % 3) for k in range(3)) for i in range(40)},
        "copy": {1100 + i: clean[i] for i in range(3)},
        "near": {1200 + i: cases.near_copy(clean[20 + i], i, 1).replace("\n", " ") for i in range(6)},
        "passage": {1300 + i: f"{clean[40 + i]}\n{passage}\n{cases.prose(70 + i, 20)}" for i in range(6)},
        "leak": {1400 + i: f"{cases.prose(800 + i, 20)} {cases.prose(95_000 + i, 40)}" for i in range(5)},
        "awkward": {1500: None, 1501: "", 1502: cases.prose(60_000, 9000)},
    }
    texts = clean | {i: t for group in planted.values() for i, t in group.items()}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    folder = scratch_folder(spark, "corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    items = [(i, cases.prose(95_000 + i, 40)) for i in range(5)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i not in planted["junk"]), 0) for i in texts if i < 1020]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, clean, planted


def test_stages(spark, corpus):
    folder, clean, planted = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        if name == "near_duplicates":
            before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stored(stage(spark, docs, folder), name)
        if name != "packing":
            assert docs.columns == COLUMNS
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "lines":
            lengths = docs.filter(F.col("n_chars") != F.coalesce(F.length("text"), F.lit(0))).count()
            assert lengths == 0
            held = docs.filter(F.col("doc_id").between(1301, 1305)).collect()
            assert all(len(r.text) < len(planted["passage"][r.doc_id]) for r in held)
    assert not ids["quality"] & set(planted["junk"])
    assert ids["quality"] >= set(clean) | set(planted["leak"])
    assert ids["lines"] == ids["quality"]
    gone = ids["lines"] - ids["near_duplicates"]
    assert gone & set(planted["copy"])
    assert not gone & set(clean)
    prints = [model_print(t) for _, t in before]
    least = {}
    for (doc, _), root in zip(before, model_groups(prints, 2), strict=True):
        least[root] = min(least.get(root, doc), doc)
    assert ids["near_duplicates"] == set(least.values())
    assert ids["near_duplicates"] - ids["decontamination"] == set(planted["leak"])
    assert ids["packing"] == ids["decontamination"]
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_run_gives_the_last_stage(spark, corpus):
    made = corpus_pipeline.run(spark, corpus[0])
    assert made.columns[:3] == ["doc_id", "start", "length"]
    assert made.count() > 100


def test_registered():
    names = contract.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] == [n for n in names if n.startswith("op")]
    assert "pipeline" not in contract.oracle_sql()


def test_empty_tables(spark):
    folder = scratch_folder(spark, "none")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
