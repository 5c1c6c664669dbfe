"""Shapes of the physical plans that scale depends on."""

from dataclasses import replace
from datetime import timedelta

import pytest
from model import at, frame, reading
from pyspark.sql import functions as F

from fleetmetrics.operators import fleet, windows
from fleetmetrics.plans import fixtures, jobs
from fleetmetrics.plans import queries as catalogue
from fleetmetrics.sources.store import INGEST_LOG, REFRESH_LOG

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    q
    for q in catalogue.CATALOGUE
    if not q.__name__.startswith("stream_")
    and q.__name__ not in (
        "ingest_job",
        "concurrent_ingest",
        "ingest_text_buffer",
        "ingest_text_refused",
        "late_recompute",
        "late_recompute_clustered",
        "period_view_store",
    )
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", LAZY, ids=lambda q: q.__name__)
def test_no_python_and_no_nested_loops(spark, query):
    text = plan(query(spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


def test_refresh_shuffles_grouped_rows_only(spark):
    """Every exchange on the refresh path sits above a partial aggregation."""
    raw = fixtures.cadence(spark, SF_DIR)
    text = plan(jobs.refresh_frames(raw, None, at("12:00:00")).updates)
    lines = text.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert exchanges
    for i in exchanges:
        assert "partial_" in lines[i + 1] or "HashAggregate" in lines[i + 1]


def test_window_metrics_use_hash_aggregation(spark):
    text = plan(windows.window_metrics(fixtures.cadence(spark, SF_DIR)))
    assert "SortAggregate" not in text and text.count("Exchange") == 1


def test_recompute_prunes_dates_and_pushes_times(spark, store):
    rows = [reading(i, "M", at("10:00:00", day=i)) for i in range(1, 6)]
    jobs.append_raw(store, store.manifest(INGEST_LOG), frame(spark, rows))
    raw = store.open("raw", store.manifest(INGEST_LOG).batches)
    affected = spark.createDataFrame(
        [("M", at("10:00:00", day=3))], "strMachineName string, dtWindowStart timestamp_ntz"
    )
    pruned = jobs._prune_to_windows(raw, affected, 2)
    text = plan(pruned)
    assert "event_date" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "dtInsert" in text.split("PushedFilters:")[1].split("]")[0]
    assert [r.nSourceId for r in pruned.collect()] == [3]


def test_period_filter_reaches_the_metrics_scan(spark, store):
    rows = [reading(i, "M", at("10:00:00", day=i)) for i in range(1, 4)]
    jobs.append_raw(store, store.manifest(INGEST_LOG), frame(spark, rows))
    jobs.refresh_metrics(store, at("10:10:00", day=3))
    since = at("10:00:00", day=3)
    view = fleet.last_period(store.metrics(since.date()), since, 60)
    text = plan(view)
    assert "window_date" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "dtWindowStart" in text.split("PushedFilters:")[1].split("]")[0]


def test_scans_read_only_the_needed_columns(spark):
    raw = fixtures.cadence(spark, SF_DIR)
    text = plan(raw.agg(F.max("nSourceId")))
    assert text.split("ReadSchema: ")[1].splitlines()[0] == "struct<event_id:bigint>"


def test_an_old_window_does_not_widen_the_read(spark, store):
    """5,001 recent starts and one of ten years ago: only their days are read."""
    old = at("10:00:00").replace(year=2014)
    starts = [old] + [at("10:00:00") + timedelta(minutes=2 * i) for i in range(5_001)]
    affected = spark.createDataFrame([("M", s) for s in starts], "strMachineName string, dtWindowStart timestamp_ntz")
    rows = [reading(i, "M", s) for i, s in enumerate([old, at("10:00:00").replace(year=2019), at("10:00:00")], 1)]
    jobs.append_raw(store, store.manifest(INGEST_LOG), frame(spark, rows))
    raw = store.open("raw", store.manifest(INGEST_LOG).batches)
    pruned = jobs._prune_to_windows(raw, affected, 2)
    assert sorted(r.nSourceId for r in pruned.collect()) == [1, 3]
    assert len(pruned.inputFiles()) == 3
    text = plan(pruned)
    assert "event_date" in text.split("PartitionFilters:")[1].split("]")[0]
    assert len(jobs._affected_days(affected, 2).collect()) == 9


def test_candidates_push_the_id_bound_after_compaction(spark, store):
    for i in range(1, 5):
        rows = [reading(10 * i + k, "M", at(f"10:{10 * i + k:02d}:00")) for k in range(3)]
        jobs.append_raw(store, store.manifest(INGEST_LOG), frame(spark, rows))
        jobs.refresh_metrics(store, at("10:50:00") + timedelta(minutes=i))
    assert store.compact(INGEST_LOG, min_batches=2)
    jobs.append_raw(store, store.manifest(INGEST_LOG), frame(spark, [reading(41, "N", at("10:49:00"))]))
    loaded, refreshed = store.manifest(INGEST_LOG), store.manifest(REFRESH_LOG)
    state = {**refreshed.state, "low_water": 41}
    scan = jobs._candidate_scan(store, loaded, replace(refreshed, state=state), at("10:58:00"), 2)
    assert any("nSourceId" in part.split("]")[0] for part in plan(scan).split("PushedFilters:")[1:])
    assert sorted(r.nSourceId for r in scan.collect()) == [41, 41, 42]


def test_overlapping_windows_need_no_lambda(spark):
    raw = fixtures.cadence(spark, SF_DIR)
    assert "lambda" not in plan(windows.cover_windows(raw, 7))


@pytest.mark.parametrize(
    "view", [fleet.latest_per_machine, fleet.machines_in_alert, fleet.machine_kpis, fleet.fleet_kpis]
)
def test_latest_windows_use_hash_aggregation(spark, view):
    made = view(fleet.metrics_view(fixtures.finished_metrics(fixtures.cadence(spark, SF_DIR))))
    assert "SortAggregate" not in plan(made)
