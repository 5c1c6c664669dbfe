"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again before the next one. All but the last keep the columns of
documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.llm import decontaminate, line_chunks, packing, quality, simhash
from fleetmetrics.llm.common import free_name, stored, table

TOKENIZER = "word_bpe_49k.json"
LEAST_SCORE = 0.7

def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as good; nulls and empty texts have the score of
    its bias, and repeated rows share theirs."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = quality.scored(docs, model, keep=docs.columns, into=score)
    return scored.filter(F.col(score) >= LEAST_SCORE).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier in the corpus; n_chars follows the text.
    No row goes; nulls and empty texts stay, and rows equal in id and text stay alike."""
    report = free_name(docs, "lines")
    cleaned = line_chunks.dedup_lines(docs, into=report)
    shorter = F.when(F.col(report)["removed"] > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", shorter.cast("long")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked by two bits or fewer: that
    of the smallest id. Nulls and texts without words are such a group."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; nulls and empty texts are clean."""
    found = free_name(docs, "found")
    benchmark = table(spark, sf_dir, "benchmark")
    scanned = decontaminate.contamination(docs, benchmark, keep=docs.columns, into=found)
    return scanned.filter(~F.col(found)["contaminated"]).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: its place in a sequence, and its token ids as little-endian 32-bit bytes."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
