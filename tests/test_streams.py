"""Streams: restart, exactly-once across failures, ticking, native windows."""

import pytest
from model import LOAD, at, frame, reading
from pyspark.sql.streaming.query import StreamingQueryException

from fleetmetrics.plans import jobs
from fleetmetrics.schemas import RAW
from fleetmetrics.sources.readers import landing_stream
from fleetmetrics.sources.store import INGEST_LOG, READINGS_LOG
from fleetmetrics.streaming import streams

NOW = {"availableNow": True}
GOOD = (
    '{"strMachineName":"M1","fA":%d,"fV":220,"nTemperature":80,"dtNow":"2024-01-01 10:00:00"}'
)


def land(spark, folder, numbers):
    rows = [(GOOD % n,) for n in numbers] + [("broken",)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(folder)


def test_readings_stream_restarts_where_it_stopped(spark, store, folder):
    for numbers in ([1, 2], [3]):
        land(spark, f"{folder}/in", numbers)
        messages = landing_stream(spark, f"{folder}/in", files_per_batch=1)
        streams.stream_readings(messages, store, f"{folder}/cp", trigger=NOW).awaitTermination()
    assert sorted((r.nId, r.fA) for r in store.buffer().collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert store.quarantine().count() == 2


@pytest.mark.parametrize("log", [READINGS_LOG, INGEST_LOG])
def test_ingest_stream_counts_a_repeated_batch_once(spark, store, folder, monkeypatch, log):
    """The batch dies before or after the buffer's commit and is run again."""
    land(spark, f"{folder}/in", [1, 2])
    real = store.commit

    def fail(which, manifest):
        if which == log:
            raise RuntimeError("lost")
        real(which, manifest)

    def run():
        messages = landing_stream(spark, f"{folder}/in")
        return streams.stream_ingest(messages, store, f"{folder}/cp", lambda: LOAD, trigger=NOW)

    monkeypatch.setattr(store, "commit", fail)
    with pytest.raises(StreamingQueryException):
        run().awaitTermination()
    assert store.raw().count() == 0
    monkeypatch.setattr(store, "commit", real)
    run().awaitTermination()
    assert sorted((r.nSourceId, r.fCurrent) for r in store.raw().collect()) == [(1, 1.0), (2, 2.0)]
    assert store.quarantine().count() == 1


def test_ticks_close_the_last_window_in_silence(spark, store, folder):
    rows = [reading(1, "M", at("10:02:00"))]
    jobs.append_raw(store, store.manifest(INGEST_LOG), frame(spark, rows))
    clock = iter([at("10:03:00"), *[at("10:05:00")] * 100])
    query = streams.stream_refresh(
        streams.ticker(spark),
        store,
        f"{folder}/cp",
        lambda: next(clock),
        trigger={"processingTime": "1 second"},
    )
    for _ in range(60):
        query.awaitTermination(1)
        if store.metrics().count():
            break
    query.stop()
    assert store.metrics().first().dtProcessing == at("10:05:00")


def test_native_windows_drop_late_rows(spark, folder):
    batches = [
        [reading(1, "M", at("10:00:00")), reading(2, "M", at("10:10:00"))],
        [reading(3, "M", at("10:01:00")), reading(4, "M", at("10:20:00"))],
    ]
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(RAW).parquet(f"{folder}/in")
        streams.stream_native_windows(
            source, f"{folder}/out", f"{folder}/cp", trigger=NOW
        ).awaitTermination()
    found = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r.dtWindowStart, r.nRecords) for r in found) == [
        (at("10:00:00"), 1),
        (at("10:10:00"), 1),
    ]


def test_native_windows_check_their_setting(spark):
    raw = frame(spark, [])
    with pytest.raises(ValueError):
        streams.native_windows(raw, window_minutes=7)
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError):
            streams.native_windows(raw)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_new_checkpoint_is_a_new_source(spark, store, folder):
    for number in (1, 2):
        land(spark, f"{folder}/in{number}", [number])
        messages = landing_stream(spark, f"{folder}/in{number}")
        streams.stream_readings(messages, store, f"{folder}/cp{number}", trigger=NOW).awaitTermination()
    assert sorted(r.fA for r in store.buffer().collect()) == [1.0, 2.0]


def test_refreshes_wait_for_odd_minutes():
    assert streams.seconds_to(at("10:04:00"), 60, 120) == 60
    assert streams.seconds_to(at("10:05:00"), 60, 120) == 0
    assert streams.seconds_to(at("10:05:01"), 60, 120) == 119
    assert streams.seconds_to(at("10:04:30").replace(microsecond=500_000), 60, 120) == 29.5
