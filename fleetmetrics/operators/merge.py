"""Upserts as pure merges of an existing frame with its updates."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmetrics.functions.clock import ntz
from fleetmetrics.schemas import CONTROL, METRICS, METRICS_KEY


def merge_metrics(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates replace rows with the same machine, start and end."""
    columns = METRICS.fieldNames()
    kept = existing.join(updates.select(*METRICS_KEY), METRICS_KEY, "left_anti")
    return kept.select(*columns).unionByName(updates.select(*columns))


def latest_metrics(log: DataFrame) -> DataFrame:
    """Newest row per key of an append log with a ``batch_id``.

    One fixed-width ``max_by`` per column keeps this a hash aggregation; a
    struct of the row would make it sort.
    """
    values = [c for c in METRICS.fieldNames() if c not in METRICS_KEY]
    newest = [F.max_by(F.col(c), F.col("batch_id")).alias(c) for c in values]
    return log.groupBy(*METRICS_KEY).agg(*newest).select(*METRICS.fieldNames())


def stamp_cursors(processed: DataFrame, as_of: datetime) -> DataFrame:
    return processed.withColumn("dtLastProcessing", ntz(as_of)).select(*CONTROL.fieldNames())


def upsert_control(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """A cursor never moves back; its timestamp is always replaced."""
    old, new = existing.alias("old"), updates.alias("new")
    return old.join(new, "strMachineName", "full").select(
        "strMachineName",
        F.greatest("old.nLastProcessedSourceId", "new.nLastProcessedSourceId").alias(
            "nLastProcessedSourceId"
        ),
        F.coalesce("new.dtLastProcessing", "old.dtLastProcessing").alias("dtLastProcessing"),
    )
