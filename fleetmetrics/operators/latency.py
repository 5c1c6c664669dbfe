"""Delays between the three clocks: event, load and processing time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _delay_by_machine(rows: DataFrame, earlier: str, later: str, count: str) -> DataFrame:
    # Subtracting keeps the zone out of it; timestampdiff would go through the
    # session's, where a change to summer time costs an hour.
    seconds = (F.col(later) - F.col(earlier)).cast("interval second").cast("long")
    return (
        rows.select("strMachineName", seconds.alias("delay"))
        .groupBy("strMachineName")
        .agg(
            F.count("*").alias(count),
            F.avg("delay").alias("AverageSeconds"),
            F.min("delay").alias("MinimumSeconds"),
            F.max("delay").alias("MaximumSeconds"),
        )
    )


def ingestion_latency(raw: DataFrame) -> DataFrame:
    """Whole seconds from a reading's event time to its load, per machine."""
    return _delay_by_machine(raw, "dtInsert", "dtLoad", "Readings")


def processing_delay(metrics: DataFrame) -> DataFrame:
    """Whole seconds from a window's end to its computation, per machine."""
    return _delay_by_machine(metrics, "dtWindowEnd", "dtProcessing", "Windows")
