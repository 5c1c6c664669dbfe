"""Continuous forms of the jobs.

Each function starts a query. Cadence is the caller's trigger, for example
``{"processingTime": "1 minute"}`` or ``{"availableNow": True}``; one
checkpoint runs one query at a time, and missed ticks are not made up.
"""

import time
from collections.abc import Callable
from concurrent.futures import Future
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmetrics.functions.clock import tiles_the_hour
from fleetmetrics.operators.windows import window_measures
from fleetmetrics.plans.jobs import ingest, receive_messages, refresh_metrics
from fleetmetrics.schemas import METRICS, METRICS_KEY
from fleetmetrics.sources.store import TelemetryStore

_LATER = ("bTemperatureAlert", "dtProcessing")  # added after the aggregation

EVERY_MINUTE = {"processingTime": "1 minute"}
EVERY_TWO_MINUTES = {"processingTime": "2 minutes"}


def _start(
    messages: DataFrame,
    action: Callable[[DataFrame, int, str], None],
    checkpoint: str,
    name: str,
    trigger: dict,
) -> StreamingQuery:
    """Run ``action`` on each micro-batch, with a source key of name and query id."""
    source: Future[str] = Future()

    def batch(rows: DataFrame, batch_id: int) -> None:
        action(rows, batch_id, source.result())

    writer = messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    query = writer.trigger(**trigger).start()
    source.set_result(f"{name}:{query.id}")
    return query


def stream_readings(
    messages: DataFrame,
    store: TelemetryStore,
    checkpoint: str,
    name: str = "readings",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Decode a message stream into the buffer and the quarantine.

    The query's id, which its checkpoint keeps, and the micro-batch id make a
    replayed batch count once; a new checkpoint is a new source.
    """

    def receive(batch: DataFrame, batch_id: int, source: str) -> None:
        receive_messages(store, batch, source, batch_id)

    return _start(messages, receive, checkpoint, name, trigger or EVERY_MINUTE)


def stream_ingest(
    messages: DataFrame,
    store: TelemetryStore,
    checkpoint: str,
    clock: Callable[[], datetime],
    name: str = "ingest",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Messages through the buffer to the raw table, each exactly once.

    A batch that failed between the two steps is picked up by its replay: the
    first step finds it done, the second goes by the id cursor.
    """

    def load(batch: DataFrame, batch_id: int, source: str) -> None:
        receive_messages(store, batch, source, batch_id)
        ingest(store, clock())

    return _start(messages, load, checkpoint, name, trigger or EVERY_MINUTE)


def ticker(spark: SparkSession) -> DataFrame:
    """A stream that fires every trigger, whether or not readings arrive."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


def seconds_to(moment: datetime, offset_seconds: int, period_seconds: int) -> float:
    """How long until the time since midnight is the offset past a multiple of the period."""
    since = moment - moment.replace(hour=0, minute=0, second=0, microsecond=0)
    return (offset_seconds - since.total_seconds()) % period_seconds


def stream_refresh(
    ticks: DataFrame,
    store: TelemetryStore,
    checkpoint: str,
    clock: Callable[[], datetime],
    trigger: dict | None = None,
    offset_seconds: int = 60,
    period_seconds: int = 120,
    **settings,
) -> StreamingQuery:
    """Refresh the metrics on a clock, so the last window closes in silence too.

    Spark fires a processing-time trigger at multiples of its interval, which is
    just when a window ends and its closing delay begins. With the default
    trigger the refresh waits until ``offset_seconds`` past a multiple of the
    period: on odd minutes. The tick's rows are not looked at. ``settings`` go
    to ``refresh_metrics``.
    """
    wait = trigger is None

    def refresh(_: DataFrame, __: int) -> None:
        if wait:
            time.sleep(seconds_to(clock(), offset_seconds, period_seconds))
        refresh_metrics(store, clock(), **settings)

    writer = ticks.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_TWO_MINUTES)).start()


def native_windows(
    readings: DataFrame, window_minutes: int = 2, watermark_seconds: int = 15
) -> DataFrame:
    """Event-time windows with Spark's own watermark.

    Not the refresh contract: readings later than the watermark are dropped and
    closed windows never change. Needs a UTC session, as the watermark column
    carries a zone, and a length that divides the hour.
    """
    if not tiles_the_hour(window_minutes):
        raise ValueError("native windows start at the epoch; the length has to divide 60")
    zone = readings.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError(f"native windows need a UTC session, not {zone}")
    zoned = readings.withColumn("event_time", F.col("dtInsert").cast("timestamp"))
    grouped = zoned.withWatermark("event_time", f"{watermark_seconds} seconds").groupBy(
        "strMachineName", F.window("event_time", f"{window_minutes} minutes")
    )
    return grouped.agg(*window_measures()).select(
        "strMachineName",
        F.col("window.start").cast("timestamp_ntz").alias("dtWindowStart"),
        F.col("window.end").cast("timestamp_ntz").alias("dtWindowEnd"),
        *[c for c in METRICS.fieldNames() if c not in (*METRICS_KEY, *_LATER)],
    )


def stream_native_windows(
    readings: DataFrame,
    folder: str,
    checkpoint: str,
    window_minutes: int = 2,
    watermark_seconds: int = 15,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append each native window to a Parquet folder once it is final."""
    windows = native_windows(readings, window_minutes, watermark_seconds)
    writer = windows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", folder).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_TWO_MINUTES)).start()
