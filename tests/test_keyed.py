"""Keyed stream state: late rows, restart, timers, replays, against the batch refresh."""

import time
from datetime import timedelta

from model import at, frame, reading, stored_control, stored_metrics

from fleetmetrics.plans import jobs
from fleetmetrics.schemas import RAW
from fleetmetrics.sources.store import INGEST_LOG, REFRESH_LOG
from fleetmetrics.streaming import keyed

NOW = {"availableNow": True}


def arrive(spark, folder, rows):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, store, folder, as_of, **settings):
    source = spark.readStream.schema(RAW).parquet(f"{folder}/in")
    query = keyed.stream_keyed_refresh(source, store, f"{folder}/cp", lambda _: as_of, trigger=NOW, **settings)
    query.awaitTermination()
    return query


def test_restarts_and_late_rows_of_any_age_follow_the_batch_refresh(spark, folder, store):
    """Each step is a new run from the checkpoint; the batch job sees the same steps."""
    twin = type(store).create(spark, f"{folder}/twin")
    steps = [
        ([reading(i, "AB"[i % 2], at("10:00:00") + timedelta(seconds=41 * i), 60 + i, i / 4) for i in range(1, 20)], at("10:12:00")),
        ([reading(30, "A", at("10:00:30"), 99, 7.5), reading(31, "C", at("10:12:10"))], at("10:30:00")),
        ([reading(40, "A", at("10:30:00", day=3)), reading(41, "B", at("10:01:59"))], at("10:31:00", day=3)),
        ([reading(50, "A", at("10:00:31"), 60, 0.5)], at("10:32:00", day=3)),
    ]
    for rows, as_of in steps:
        arrive(spark, folder, rows)
        run(spark, store, folder, as_of)
        jobs.append_raw(twin, twin.manifest(INGEST_LOG), frame(spark, rows))
        jobs.refresh_metrics(twin, as_of)
        assert stored_metrics(store) == stored_metrics(twin)
        assert stored_control(store) == stored_control(twin)


def test_overlapping_windows_and_a_new_machines_old_rows(spark, folder, store):
    rows = [reading(1, "M", at("10:59:30")), reading(2, "M", at("11:01:30")), reading(9, "N", at("10:00:00")), reading(3, "N", at("10:00:00", day=3))]
    arrive(spark, folder, rows)
    run(spark, store, folder, at("10:30:00", day=3), window_minutes=7)
    # M is too old for a first look; N's old reading waits for its next look.
    assert {(m, s) for m, s, _ in stored_metrics(store)} == {("N", at("10:00:00", day=3))}
    arrive(spark, folder, [reading(10, "M", at("10:20:00", day=3)), reading(11, "N", at("10:20:00", day=3))])
    run(spark, store, folder, at("11:00:00", day=3), window_minutes=7)
    found = stored_metrics(store)
    assert ("N", at("10:00:00"), at("10:07:00")) in found
    assert stored_control(store)["N"][0] == 11


def test_a_timer_closes_the_last_window_in_silence(spark, folder, store):
    arrive(spark, folder, [reading(1, "M", at("10:02:00"))])
    started, base = int(time.time() * 1000), at("10:03:45")
    # The site's clock stands at 10:03:55 when the query starts, and runs on.
    source = spark.readStream.schema(RAW).parquet(f"{folder}/in")
    query = keyed.stream_keyed_refresh(
        source,
        store,
        f"{folder}/cp",
        lambda wall: base + timedelta(milliseconds=wall - started),
        trigger={"processingTime": "1 second"},
        watermark_seconds=15,
    )
    try:
        for _ in range(90):
            query.awaitTermination(1)
            if store.manifest(REFRESH_LOG).batches:
                break
    finally:
        query.stop()
    (row,) = stored_metrics(store).items()
    assert row[0] == ("M", at("10:02:00"), at("10:04:00"))
    assert row[1][-1] >= at("10:04:15")
    assert stored_control(store)["M"][0] == 1


def test_a_replayed_batch_counts_once(spark, store):
    out = spark.createDataFrame([("M", 0, 1, 2, 2, *[1.0] * 9, 2, 60_000_000)], keyed.OUT_SCHEMA)
    assert keyed.commit_windows(store, out, "s", 0, 2, 85) == 1
    assert keyed.commit_windows(store, out, "s", 0, 2, 85) == 0
    assert keyed.commit_windows(store, out.limit(0), "s", 1, 2, 85) == 0
    assert store.metrics().count() == 1
