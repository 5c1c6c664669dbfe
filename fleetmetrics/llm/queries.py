"""The operators over whole test tables, with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.llm import (
    content_sort,
    decontaminate,
    fill_middle,
    hypervectors,
    line_chunks,
    masked_lm,
    packing,
    quality,
    resample,
    secret_index,
    simhash,
    url_rules,
    warc,
)
from fleetmetrics.llm.common import table
from fleetmetrics.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, benchmark).select("doc_id", "found.*")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labels are those of the document whose number its path holds."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.regexp_extract(url_rules.path(F.col("url")), "/([0-9]+)", 1).try_cast("long")
    bad = labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    labelled = pages.select("url", number.alias("doc_id")).join(bad, "doc_id")
    return url_rules.judge(pages, url_rules.mine(labelled)).drop("mined")


def op3_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "warc")
    files = warc.write_warc(table(spark, sf_dir, "pages"), folder)
    read = warc.records(warc.read_warc(files, folder, with_payload=False))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_index.find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_index.BASE]
    counts = [secret_index.count_of(F.col("secrets"), k).alias(f"n_{k}") for k in base]
    digest = F.sha2(secret_index.listed(F.col("secrets"), base), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secret_index.listed(F.col("secrets")).alias("spans"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_chunks.dedup_lines(table(spark, sf_dir, "documents"), keep=["doc_id", "text"])
    spans = F.transform("lines.spans", lambda s: F.concat_ws(":", s["first"], s["past"]))
    return cleaned.select(
        "doc_id",
        F.col("lines.n_lines").alias("n_lines"),
        F.col("lines.removed").alias("n_removed"),
        F.array_join(spans, ",").alias("removed_lines"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.7).cast("int")
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and checksum are those of the ids that are joined to the plan."""
    made = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    length = F.expr("octet_length(ids) div 4").alias("length")
    return made.select("doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = hypervectors.identified(docs, hypervectors.train(docs))
    return found.select("doc_id", quality.held_out().alias("held_out"), "lang_pred", "score")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents")).select("doc_id", "fim.*")
    again = fill_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return made.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_decontamination,
            op2_url_rules,
            op3_masked_lm,
            op4_warc,
            op5_secret_index,
            op6_simhash,
            op7_content_sort,
            op8_line_chunks,
            op9_quality,
            op10_packing,
            op11_language,
            op12_fill_middle,
            op13_resample,
        )
    }
