"""Exact duplicates by sorting the texts themselves.

Spark samples splitters and range-partitions the rows, sorts each range on
disk, and compares each text with its neighbour in full. The range key is the
start of the normalised text and of its digest, so that the driver's sample of
keys stays small whatever the length of the texts; rows compare by whole texts.

A text whose copies fill more than half a partition is dealt over several by a
hash of the id. There are at most two such texts for each partition, which
bounds the broadcast list of them; their parts are joined again afterwards.

Null texts count as empty. Of equal texts the smallest id stays, and of
repeated ids one row; a null id stays only if no copy has an id. Columns other
than the two named are not read.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmetrics.llm.common import SPACE, shuffle_partitions, stored, text_or_empty

PREFIX = 16


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256; a row per document."""
    spark = docs.sparkSession
    n = partitions or shuffle_partitions(spark)
    body = F.regexp_replace(text_or_empty(text), SPACE, " ")
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"))
    rows = rows.withColumn("sha", F.sha2("body", 256))

    by_text = rows.groupBy("sha").agg(
        F.count("*").alias("copies"), F.sum(F.octet_length("body") + 64).alias("bytes")
    )
    weights = stored(by_text, "weights")
    total = weights.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    room = max(total // (2 * n), 1)
    crowded = weights.filter((F.col("bytes") > room) & (F.col("copies") > 1))
    crowded = crowded.select("sha", F.ceil(F.col("bytes") / room).alias("parts"))

    spread = rows.join(F.broadcast(crowded), "sha", "left")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), "parts"))
    spread = spread.withColumns(
        {"part": part, "start": F.substring("body", 1, PREFIX), "short": F.substring("sha", 1, PREFIX)}
    )
    ranged = spread.repartitionByRange(n, "start", "short", "part")
    equal = Window.partitionBy("start", "short", "part", "sha", "body")
    ordered = equal.orderBy(F.asc_nulls_last("doc_id"))
    compared = ranged.select(
        "doc_id",
        "sha",
        F.col("parts").isNotNull().alias("split"),
        F.row_number().over(ordered).alias("place"),
        F.min("doc_id").over(equal).alias("part_keep"),
        F.count("*").over(equal).alias("part_size"),
    )
    compared = stored(compared, "compared")

    heads = compared.filter(F.col("split") & (F.col("place") == 1))
    joined = heads.groupBy("sha").agg(F.min("part_keep").alias("keep"), F.sum("part_size").alias("size"))
    result = compared.join(F.broadcast(joined), "sha", "left")
    keep = F.when(F.col("split"), F.col("keep")).otherwise(F.col("part_keep"))
    return result.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", "part_size").alias("group_size"),
        ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
