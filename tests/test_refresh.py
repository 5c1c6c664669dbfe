"""Hand-computed refresh scenarios."""

from datetime import timedelta

import pytest
from model import at, frame, reading, stored_control, stored_metrics
from pyspark.sql import functions as F

from fleetmetrics.operators import merge, windows
from fleetmetrics.plans import jobs
from fleetmetrics.schemas import CONTROL
from fleetmetrics.sources.store import INGEST_LOG, REFRESH_LOG


def load(store, *rows):
    return jobs.append_raw(store, store.manifest(INGEST_LOG), frame(store.spark, list(rows)))


def updates(spark, rows, as_of, control=None, **settings):
    known = None if control is None else spark.createDataFrame(control, CONTROL)
    frames = jobs.refresh_frames(frame(spark, rows), known, as_of, **settings)
    found = frames.updates.orderBy("dtWindowStart").collect()
    return [(r.dtWindowStart.strftime("%H:%M"), r.nRecords) for r in found]


def test_boundary_readings_open_the_next_window(spark):
    rows = [reading(i, "M", at(t)) for i, t in enumerate(["10:02:00", "10:03:59", "10:04:00"], 1)]
    assert updates(spark, rows, at("11:00:00")) == [("10:02", 2), ("10:04", 1)]


def test_window_closes_at_end_plus_watermark(spark):
    rows = [reading(1, "M", at("10:03:00"))]
    assert updates(spark, rows, at("10:04:14")) == []
    assert updates(spark, rows, at("10:04:15")) == [("10:02", 1)]


def test_first_load_bound_is_one_day_inclusive(spark):
    as_of = at("10:00:30", day=3)
    apart = [reading(1, "M", at("10:00:30", day=2)), reading(2, "M", at("09:59:59", day=2))]
    assert updates(spark, apart, as_of) == [("10:00", 1)]
    shared = [reading(1, "M", at("10:00:30", day=2)), reading(2, "M", at("10:00:29", day=2))]
    assert updates(spark, shared, as_of) == [("10:00", 2)]


def test_windows_that_do_not_divide_the_hour_overlap(spark):
    rows = [reading(1, "M", at("10:59:30")), reading(2, "M", at("11:01:30"))]
    found = updates(spark, rows, at("12:00:00"), window_minutes=7)
    assert found == [("10:56", 2), ("11:00", 1)]


def test_windows_longer_than_an_hour(spark):
    rows = [reading(1, "M", at("10:10:00")), reading(2, "M", at("11:20:00"))]
    found = updates(spark, rows, at("15:00:00"), window_minutes=90)
    assert found == [("10:00", 2), ("11:00", 1)]


@pytest.mark.parametrize("maximum, alert", [(84, False), (85, True)])
def test_alert_from_the_threshold_on(spark, maximum, alert):
    rows = [reading(1, "M", at("10:00:00"), 60), reading(2, "M", at("10:00:01"), maximum)]
    found = jobs.refresh_frames(frame(spark, rows), None, at("11:00:00")).updates.first()
    assert found.bTemperatureAlert is alert


def test_parameters_are_checked(store):
    with pytest.raises(ValueError):
        jobs.refresh_metrics(store, at("10:00:00"), window_minutes=0)
    with pytest.raises(ValueError):
        jobs.refresh_metrics(store, at("10:00:00"), watermark_seconds=-1)
    with pytest.raises(ValueError):
        windows.cursor_updates(store.control(), at("10:00:00"), cursor="other")


def test_late_reading_recomputes_and_rerun_changes_nothing(store):
    load(store, reading(1, "M", at("10:02:00"), 60), reading(2, "N", at("10:02:10"), 60))
    assert jobs.refresh_metrics(store, at("10:05:00")) == jobs.RefreshCounts(2, 2)
    load(store, reading(99, "M", at("10:03:30"), 90))
    assert jobs.refresh_metrics(store, at("10:07:00")) == jobs.RefreshCounts(1, 1)
    metrics, control = stored_metrics(store), stored_control(store)
    assert metrics["M", at("10:02:00"), at("10:04:00")][:3] == (1, 99, 2)
    assert control == {"M": (99, at("10:07:00")), "N": (2, at("10:05:00"))}
    assert jobs.refresh_metrics(store, at("10:07:00")) == jobs.RefreshCounts(0, 0)
    assert (stored_metrics(store), stored_control(store)) == (metrics, control)


@pytest.mark.parametrize("rule", [windows.MAX_CLOSED, windows.BELOW_OPEN])
def test_cursor_may_skip_an_open_window(store, rule):
    load(store, reading(10, "M", at("10:02:50")), reading(11, "M", at("10:01:59")))
    for as_of in (at("10:03:00"), at("10:05:00")):
        jobs.refresh_metrics(store, as_of, cursor=rule)
    found = {start.strftime("%H:%M") for _, start, _ in stored_metrics(store)}
    assert found == ({"10:00"} if rule == windows.MAX_CLOSED else {"10:00", "10:02"})


def test_old_readings_count_once_the_machine_has_a_cursor(store):
    load(store, reading(10, "M", at("10:00:00", day=5)), reading(11, "M", at("10:00:00", day=2)))
    assert jobs.refresh_metrics(store, at("10:10:00", day=5)).processed_metrics == 1
    assert stored_control(store)["M"][0] == 10
    assert jobs.refresh_metrics(store, at("10:12:00", day=5)).processed_metrics == 1
    assert stored_control(store)["M"][0] == 11


def test_readings_from_a_clock_far_ahead_wait_for_their_time(store):
    load(store, reading(1, "M", at("10:00:00")), reading(2, "M", at("10:00:00", day=5)))
    assert jobs.refresh_metrics(store, at("10:10:00")).processed_metrics == 1
    load(store, reading(3, "N", at("10:11:00")))
    assert jobs.refresh_metrics(store, at("10:20:00")).processed_metrics == 1
    assert store.manifest(REFRESH_LOG).state["low_water"] == 4
    assert jobs.refresh_metrics(store, at("10:30:00", day=4)).processed_metrics == 0
    assert jobs.refresh_metrics(store, at("10:30:00", day=5)).processed_metrics == 1


def test_scan_leaves_out_batches_below_the_low_water_mark(store):
    load(store, *[reading(i, "M", at("10:00:00")) for i in range(1, 6)])
    jobs.refresh_metrics(store, at("10:10:00"))
    load(store, reading(6, "M", at("10:11:00")))
    scan = jobs._candidate_scan(
        store,
        store.manifest(INGEST_LOG),
        store.manifest(REFRESH_LOG),
        at("10:20:00"),
        2,
    )
    assert [r.nSourceId for r in scan.collect()] == [6]
    assert all("batch_id=2" in f for f in scan.inputFiles())


def test_failure_before_the_commit_leaves_both_tables_as_they_were(store, monkeypatch):
    load(store, reading(1, "M", at("10:02:00")))
    real = store.commit

    def fail(log, manifest):
        if log == REFRESH_LOG:
            raise RuntimeError("lost")
        real(log, manifest)

    monkeypatch.setattr(store, "commit", fail)
    with pytest.raises(RuntimeError):
        jobs.refresh_metrics(store, at("10:05:00"))
    assert stored_metrics(store) == {} and stored_control(store) == {}
    monkeypatch.setattr(store, "commit", real)
    assert jobs.refresh_metrics(store, at("10:05:00")) == jobs.RefreshCounts(1, 1)
    assert stored_control(store) == {"M": (1, at("10:05:00"))}


def test_cursor_never_moves_back(spark):
    old = spark.createDataFrame([("M", 50, at("10:00:00")), ("K", 1, at("10:00:00"))], CONTROL)
    new = spark.createDataFrame([("M", 40, at("11:00:00")), ("N", 7, at("11:00:00"))], CONTROL)
    found = {tuple(r) for r in merge.upsert_control(old, new).collect()}
    assert found == {
        ("M", 50, at("11:00:00")),
        ("K", 1, at("10:00:00")),
        ("N", 7, at("11:00:00")),
    }


def test_many_affected_days_are_picked_while_running(spark, store, monkeypatch):
    monkeypatch.setattr(jobs, "PUSHED_DAYS", 2)
    load(store, *[reading(i, "M", at("10:02:00", day=i)) for i in range(1, 9)])
    assert jobs.refresh_metrics(store, at("11:00:00", day=8)).processed_metrics == 1
    load(store, *[reading(20 + i, "M", at("10:03:00", day=i)) for i in range(1, 9)])
    assert jobs.refresh_metrics(store, at("12:00:00", day=8)).processed_metrics == 8
    assert {r.nRecords for r in store.metrics().collect()} == {2}


def test_grouped_triggers_equal_the_row_by_row_definition(spark):
    """The refresh path groups first; the operators filter row by row."""
    import random

    rng = random.Random(5)
    now = at("12:00:00", day=3)
    rows = [
        reading(i, rng.choice("ABCD"), now - timedelta(seconds=rng.randint(-300, 150_000)))
        for i in range(1, 600)
    ]
    raw = frame(spark, rows)
    control = spark.createDataFrame([("A", 300, now), ("B", 598, now), ("C", 0, now)], CONTROL)
    for length in (2, 7):
        pending = windows.window_pending(raw, control, now, length)
        grouped = windows.closed_windows(pending, now, 15, length)
        candidates = windows.candidate_readings(raw, control, now)
        closed = windows.closed_window_readings(
            windows.assign_windows(candidates, length), now, 15, length
        )
        key = windows.WINDOW_KEY
        assert {tuple(r) for r in grouped.select(*key).collect()} == {
            tuple(r) for r in windows.affected_windows(closed).collect()
        }
        assert {tuple(r) for r in windows.cursor_updates(pending, now, 15, length).collect()} == {
            tuple(r) for r in windows.processed_sources(closed).collect()
        }


def test_compaction_keeps_the_tables_and_later_updates_win(store):
    for i in range(1, 4):
        load(store, reading(i, "M", at("10:02:00"), 60 + i))
        jobs.refresh_metrics(store, at("10:05:00") + timedelta(minutes=2 * i))
    before = stored_metrics(store)
    assert store.compact(INGEST_LOG, min_batches=2) and store.compact(REFRESH_LOG, min_batches=2)
    assert stored_metrics(store) == before
    assert len(store.manifest(REFRESH_LOG).batches) == 1
    load(store, reading(9, "M", at("10:02:30"), 99))
    assert jobs.refresh_metrics(store, at("10:20:00")) == jobs.RefreshCounts(1, 1)
    assert stored_metrics(store)["M", at("10:02:00"), at("10:04:00")][:3] == (1, 9, 4)
    since = store.metrics(since=at("00:00:00").date())
    assert since.count() == 1
    assert store.metrics(since=at("00:00:00", day=2).date()).count() == 0
    assert store.raw().filter(F.col("nSourceId") == 9).count() == 1


def test_creating_an_existing_store_keeps_it(store):
    for i in range(1, 5):  # the newest manifest is back in the first slot
        load(store, reading(i, "M", at("10:02:00")))
    again = type(store).create(store.spark, store.root)
    assert again.manifest(INGEST_LOG) == store.manifest(INGEST_LOG)
    assert again.raw().count() == 4
