"""Runs of source ids per machine, which tell where two loads can share rows.

A run is a stretch of ids of one machine without a gap above ``GAP``. Shorter gaps
are closed, so runs cover a load's ids and may cover some more: rows are compared
where runs of two loads meet, and nowhere else.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ids of a block, of which a machine has one row before runs are put together.
GAP = 1 << 16
RUNS = T.StructType(
    [
        T.StructField("strMachineName", T.StringType()),
        T.StructField("nLow", T.LongType()),
        T.StructField("nHigh", T.LongType()),
    ]
)
_ALL_BEFORE = (Window.unboundedPreceding, -1)


def id_runs(rows: DataFrame, gap: int = GAP) -> DataFrame:
    """RUNS of readings. Blocks are aggregated in the map tasks; only they are sorted."""
    block = F.floor(F.col("nSourceId") / gap).alias("block")
    ends = (F.min("nSourceId").alias("nLow"), F.max("nSourceId").alias("nHigh"))
    return merged_runs(rows.groupBy("strMachineName", block).agg(*ends).drop("block"), gap)


def merged_runs(runs: DataFrame, gap: int = GAP) -> DataFrame:
    """Runs that meet, or lie at most ``gap`` apart, as one."""
    ordered = Window.partitionBy("strMachineName").orderBy("nLow", "nHigh")
    reached = F.max("nHigh").over(ordered.rowsBetween(*_ALL_BEFORE))
    starts = F.coalesce(F.col("nLow") - reached > gap, F.lit(True)).cast("int")
    number = F.sum("starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    numbered = runs.withColumn("starts", starts).withColumn("run", number)
    merged = numbered.groupBy("strMachineName", "run").agg(F.min("nLow").alias("nLow"), F.max("nHigh").alias("nHigh"))
    return merged.select(*RUNS.fieldNames())


def shared_runs(one: DataFrame, other: DataFrame) -> DataFrame:
    """RUNS that cover what both sides cover.

    Runs are swept in the order of their starts: each is cut where the other side has
    reached so far. No two runs are paired.
    """
    both = one.withColumn("side", F.lit(0)).unionByName(other.withColumn("side", F.lit(1)))
    before = Window.partitionBy("strMachineName").orderBy("nLow", "side").rowsBetween(*_ALL_BEFORE)
    reached = [F.max(F.when(F.col("side") == s, F.col("nHigh"))).over(before) for s in (0, 1)]
    met = F.when(F.col("side") == 0, reached[1]).otherwise(reached[0])
    found = both.withColumn("met", met).filter("met >= nLow")
    return found.select("strMachineName", "nLow", F.least("nHigh", "met").alias("nHigh"))


def id_ranges(runs: DataFrame, most: int) -> list[tuple[int, int]]:
    """The ids of all machines' runs as disjoint ranges; one range for more runs than ``most``."""
    found = [(r.nLow, r.nHigh) for r in runs.select("nLow", "nHigh").distinct().limit(most + 1).collect()]
    if len(found) > most:
        ends = runs.agg(F.min("nLow").alias("low"), F.max("nHigh").alias("high")).first()
        found = [(ends.low, ends.high)]
    return joined_ranges(found)


def joined_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same ids as disjoint ranges in order."""
    joined: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if joined and low <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    return joined
