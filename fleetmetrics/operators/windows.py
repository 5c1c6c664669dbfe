"""The window-metrics pipeline: candidates, affected windows, recompute, cursors.

Readings are never joined row by row on the refresh path. Both its passes group
by (machine, window) first, which collapses a hot machine or window inside the
map tasks, and only the much smaller grouped rows meet the control table.
"""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmetrics.functions.clock import (
    covering_windows,
    minutes,
    ntz,
    tiled_start,
    tiles_the_hour,
    window_start,
)
from fleetmetrics.schemas import METRICS

FIRST_LOAD_BOUND = timedelta(days=1)

MAX_CLOSED = "max_closed"
BELOW_OPEN = "below_open"

WINDOW_KEY = ["strMachineName", "dtWindowStart"]


def check_parameters(window_minutes: int, watermark_seconds: int) -> None:
    if window_minutes <= 0:
        raise ValueError(f"the window needs a positive length, got {window_minutes} minutes")
    if watermark_seconds < 0:
        raise ValueError(f"the watermark is {watermark_seconds} s; it has to be 0 or more")


def assign_windows(readings: DataFrame, window_minutes: int = 2) -> DataFrame:
    """Add ``dtWindowStart``, the one window a reading is assigned to."""
    find = tiled_start if tiles_the_hour(window_minutes) else window_start
    return readings.withColumn("dtWindowStart", find(F.col("dtInsert"), window_minutes))


def cover_windows(readings: DataFrame, window_minutes: int = 2) -> DataFrame:
    """One row per reading and window whose range holds it."""
    if tiles_the_hour(window_minutes):
        return assign_windows(readings, window_minutes)
    return readings.withColumn(
        "dtWindowStart", F.explode(covering_windows(F.col("dtInsert"), window_minutes))
    )


def last_closed_start(as_of: datetime, watermark_seconds: int, window_minutes: int) -> datetime:
    """The latest start whose window has ended, closing delay included."""
    return as_of - timedelta(seconds=watermark_seconds) - timedelta(minutes=window_minutes)


def candidate_readings(readings: DataFrame, control: DataFrame, as_of: datetime) -> DataFrame:
    """Readings past their machine's cursor, or recent ones of a new machine."""
    cursors = control.select("strMachineName", "nLastProcessedSourceId")
    cursor = F.col("nLastProcessedSourceId")
    recent = F.col("dtInsert") >= ntz(as_of - FIRST_LOAD_BOUND)
    return (
        readings.join(cursors, "strMachineName", "left")
        .filter(
            (cursor.isNotNull() & (F.col("nSourceId") > cursor)) | (cursor.isNull() & recent)
        )
        .select(*readings.columns)
    )


def closed_window_readings(
    candidates: DataFrame,
    as_of: datetime,
    watermark_seconds: int = 15,
    window_minutes: int = 2,
) -> DataFrame:
    """Candidates whose window ended at least the closing delay ago.

    Expects ``dtWindowStart``. The bound on ``dtInsert`` follows from the one
    on the start; it is there because it reaches the Parquet scan.
    """
    last = last_closed_start(as_of, watermark_seconds, window_minutes)
    end = last + timedelta(minutes=window_minutes)
    return candidates.filter(
        (F.col("dtWindowStart") <= ntz(last)) & (F.col("dtInsert") < ntz(end))
    )


def affected_windows(closed: DataFrame) -> DataFrame:
    return closed.select(*WINDOW_KEY).distinct()


def window_measures() -> list[Column]:
    """Id range, count, and average, minimum and maximum of each measure."""
    measures = [
        F.min("nSourceId").alias("nFirstSourceId"),
        F.max("nSourceId").alias("nLastSourceId"),
        F.count("*").cast("int").alias("nRecords"),
    ]
    for column, prefix in (("fCurrent", "f"), ("fVoltage", "f"), ("nTemperature", "n")):
        name = column[1:]
        measures += [
            F.avg(column).alias(f"fAverage{name}"),
            F.min(column).alias(f"{prefix}Minimum{name}"),
            F.max(column).alias(f"{prefix}Maximum{name}"),
        ]
    return measures


def window_metrics(readings: DataFrame, window_minutes: int = 2) -> DataFrame:
    """All measures of every (machine, window) that the readings fall into."""
    grouped = cover_windows(readings, window_minutes).groupBy(*WINDOW_KEY)
    return grouped.agg(*window_measures()).withColumn(
        "dtWindowEnd", F.col("dtWindowStart") + minutes(window_minutes)
    )


def recompute_windows(
    readings: DataFrame, affected: DataFrame, window_minutes: int = 2
) -> DataFrame:
    """Full metrics of the affected windows, old readings included.

    ``affected`` holds each pair once, so the join only selects. It follows the
    aggregation and uses its partitioning; a semi-join would be moved below it,
    to a look-up for every reading.
    """
    return window_metrics(readings, window_minutes).join(
        affected.select(*WINDOW_KEY), WINDOW_KEY
    )


def flag_alerts(metrics: DataFrame, threshold: int = 85) -> DataFrame:
    """``bTemperatureAlert``: the hottest rounded reading reaches the threshold."""
    return metrics.withColumn(
        "bTemperatureAlert", F.col("nMaximumTemperature") >= F.lit(threshold)
    )


def stamp_metrics(metrics: DataFrame, as_of: datetime) -> DataFrame:
    """Add the processing time and put the columns in table order."""
    return metrics.withColumn("dtProcessing", ntz(as_of)).select(*METRICS.fieldNames())


def processed_sources(closed: DataFrame) -> DataFrame:
    """The highest eligible source id per machine."""
    return closed.groupBy("strMachineName").agg(
        F.max("nSourceId").alias("nLastProcessedSourceId")
    )


def successful_machines(processed: DataFrame, written: DataFrame) -> DataFrame:
    """Processed sources of the machines that have written metrics."""
    return processed.join(
        written.select("strMachineName").distinct(), "strMachineName", "left_semi"
    )


def window_pending(
    readings: DataFrame, control: DataFrame, as_of: datetime, window_minutes: int = 2
) -> DataFrame:
    """Candidate source ids per assigned window, open windows included.

    A window holds a reading past the cursor exactly when its highest id is
    past it, so ids can be grouped before the cursor is known. For a machine
    without a cursor only its recent ids count. ``nFirstPendingId`` is a lower
    bound: a window may also hold ids at or below the cursor.
    """
    recent = F.col("dtInsert") >= ntz(as_of - FIRST_LOAD_BOUND)
    source = F.col("nSourceId")
    grouped = (
        assign_windows(readings, window_minutes)
        .groupBy(*WINDOW_KEY)
        .agg(
            F.min(source).alias("__first"),
            F.max(source).alias("__last"),
            F.min(F.when(recent, source)).alias("__first_recent"),
            F.max(F.when(recent, source)).alias("__last_recent"),
        )
    )
    return pending_against(grouped, control)


def pending_against(grouped: DataFrame, control: DataFrame) -> DataFrame:
    """Keep the windows with ids past the given cursors."""
    cursor = F.col("nLastProcessedSourceId")
    known = cursor.isNotNull()
    first: Column = F.when(known, F.greatest("__first", cursor + 1)).otherwise(
        F.col("__first_recent")
    )
    last: Column = F.when(known, F.when(F.col("__last") > cursor, F.col("__last"))).otherwise(
        F.col("__last_recent")
    )
    bounds = [c for c in grouped.columns if c.startswith("__")]
    return (
        grouped.join(
            control.select("strMachineName", "nLastProcessedSourceId"),
            "strMachineName",
            "left",
        )
        .withColumn("nFirstPendingId", first)
        .withColumn("nLastPendingId", last)
        .filter(F.col("nLastPendingId").isNotNull())
        .select(*WINDOW_KEY, *bounds, "nFirstPendingId", "nLastPendingId")
    )


def closed_windows(
    windows: DataFrame, as_of: datetime, watermark_seconds: int = 15, window_minutes: int = 2
) -> DataFrame:
    last = last_closed_start(as_of, watermark_seconds, window_minutes)
    return windows.filter(F.col("dtWindowStart") <= ntz(last))


def cursor_updates(
    pending: DataFrame,
    as_of: datetime,
    watermark_seconds: int = 15,
    window_minutes: int = 2,
    cursor: str = MAX_CLOSED,
) -> DataFrame:
    """New cursor per machine with a closed pending window.

    ``max_closed`` moves to the highest closed id, even past ids of windows
    that are still open. ``below_open`` stops short of the first such id.
    """
    if cursor not in (MAX_CLOSED, BELOW_OPEN):
        raise ValueError(f"unknown cursor rule {cursor!r}")
    last = last_closed_start(as_of, watermark_seconds, window_minutes)
    is_closed = F.col("dtWindowStart") <= ntz(last)
    per_machine = (
        pending.groupBy("strMachineName")
        .agg(
            F.max(F.when(is_closed, F.col("nLastPendingId"))).alias("closed_id"),
            F.min(F.when(~is_closed, F.col("nFirstPendingId"))).alias("open_id"),
        )
        .filter(F.col("closed_id").isNotNull())
    )
    target = F.col("closed_id")
    if cursor == BELOW_OPEN:
        target = F.least(target, F.col("open_id") - 1)
    return per_machine.select("strMachineName", target.alias("nLastProcessedSourceId"))
