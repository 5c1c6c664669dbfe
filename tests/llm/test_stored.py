"""Written intermediates leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from fleetmetrics.llm.common import stored


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_once_the_frame_is_written(spark):
    before = shuffle_files(spark)
    frame = spark.range(2000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    made = stored(frame, "sums")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert {(r.k, r.n) for r in made.collect()} == {(k, sum(range(k, 2000, 7))) for k in range(7)}
