"""Windows merged from minutes, against the same windows computed from all readings."""

import math
import random
from datetime import timedelta
from fractions import Fraction

import pytest
from model import at, frame, reading, stored_metrics
from pyspark.sql import functions as F

from fleetmetrics.operators import partials, windows
from fleetmetrics.plans import jobs
from fleetmetrics.sources.store import INGEST_LOG


def load(store, *rows):
    return jobs.append_raw(store, store.manifest(INGEST_LOG), frame(store.spark, list(rows)))


def many(seed, count=400):
    chance = random.Random(seed)
    return [
        reading(i, chance.choice("ABC"), at("10:00:00") + timedelta(milliseconds=chance.randint(0, 9_000_000)), chance.randint(-5, 90), chance.uniform(-500, 500), chance.choice([0.1, 220.0, 1e9 / 3]))
        for i in range(count)
    ]


def keyed(metrics):
    return {(r.strMachineName, r.dtWindowStart): r for r in metrics.collect()}


@pytest.mark.parametrize("length", [1, 2, 7, 60, 90])
def test_equal_to_the_recompute_for_any_length(spark, length):
    rows = many(length)
    raw = frame(spark, rows)
    minutes = partials.minute_partials(frame(spark, rows[:150])).unionByName(partials.minute_partials(frame(spark, rows[150:])))
    affected = windows.affected_windows(windows.assign_windows(raw, length))
    wanted = keyed(windows.recompute_windows(raw, affected, length))
    found = keyed(partials.merge_windows(minutes, affected, length))
    assert set(found) == set(wanted)
    for key, row in found.items():
        for name, value in wanted[key].asDict().items():
            if isinstance(value, float):
                assert math.isclose(row[name], value, rel_tol=1e-12, abs_tol=1e-12), name
            else:
                assert row[name] == value, name
        assert row.nInexact == 0


def test_averages_are_those_of_exact_sums_however_the_loads_are_cut(spark):
    rows = many(77, 300)
    results = []
    for cut in (1, 100, 299):
        minutes = partials.minute_partials(frame(spark, rows[:cut])).unionByName(partials.minute_partials(frame(spark, rows[cut:])))
        results.append({k: (r.fAverageCurrent, r.fAverageVoltage) for k, r in keyed(partials.window_metrics_of(minutes, 60)).items()})
    assert results[0] == results[1] == results[2]
    for (machine, start), (current, _) in results[0].items():
        own = [Fraction(r[2]) for r in rows if r[1] == machine and start <= r[5] < start + timedelta(hours=1)]
        assert current == pytest.approx(float(sum(own) / len(own)), rel=1e-15)


@pytest.mark.parametrize("value, held", [(0.1, True), (-1e12 / 7, True), (2.0**42, True), (0.0, True), (2.0**43, False), (1e300, False), (float("nan"), False), (float("inf"), False), (1e-30, False)])
def test_values_that_two_numbers_hold(spark, value, held):
    row = frame(spark, [reading(1, "M", at("10:00:00"), current=value)])
    assert row.select(partials.inexact().alias("x")).first().x is (not held)
    assert partials.minute_partials(row).first().nInexact == int(not held)


def test_a_late_reading_reads_no_readings(store, monkeypatch):
    """The second look is at minutes: of raw only the new load is opened."""
    load(store, *many(5, 60))
    # After its first refresh a machine's older ids are looked at once more.
    for minute in (0, 1):
        jobs.refresh_metrics(store, at(f"13:0{minute}:00"))
    load(store, reading(900, "A", at("10:00:30"), 70, 1.5))
    opened = []
    real = store.open

    def seen(table, batches):
        made = real(table, batches)
        opened.append((table, made))
        return made

    monkeypatch.setattr(store, "open", seen)
    assert jobs.refresh_metrics(store, at("13:02:00")).processed_metrics == 1
    raw_files = {f for table, made in opened if table == "raw" for f in made.inputFiles()}
    assert raw_files and all("batch_id=2/" in f for f in raw_files)
    rows = sum(made.count() for table, made in opened if table == "partials")
    assert 0 < rows <= 61


def test_values_beyond_the_sums_go_by_their_readings(store):
    load(store, reading(1, "A", at("10:00:00"), 70, 1e300), reading(2, "B", at("10:00:00"), 70, 2.5))
    load(store, reading(3, "A", at("10:01:00"), 70, 1e300), reading(4, "B", at("10:01:00"), 70, 3.5))
    assert store.manifest(INGEST_LOG).state["inexact"]
    jobs.refresh_metrics(store, at("11:00:00"))
    found = stored_metrics(store)
    assert found["A", at("10:00:00"), at("10:02:00")][2:4] == (2, 1e300)
    assert found["B", at("10:00:00"), at("10:02:00")][2:4] == (2, 3.0)


def test_a_store_without_minutes_goes_by_readings(store):
    load(store, reading(1, "A", at("10:00:00"), 70, 1.0))
    manifest = store.manifest(INGEST_LOG)
    state = {k: v for k, v in manifest.state.items() if k != "partials"}
    store.commit(INGEST_LOG, type(manifest)(manifest.snapshot + 1, manifest.batches, state))
    load(store, reading(2, "A", at("10:01:00"), 70, 2.0))
    jobs.refresh_metrics(store, at("11:00:00"))
    assert stored_metrics(store)["A", at("10:00:00"), at("10:02:00")][2:4] == (2, 1.5)


def test_one_machine_opens_few_files(spark, store):
    """666 machines over a day, merged along the curve: a late reading of one of them."""
    day = spark.range(666 * 96).select(
        F.col("id").alias("nSourceId"),
        F.concat(F.lit("Machine"), F.col("id") % 666).alias("strMachineName"),
        F.lit(1.5).alias("fCurrent"),
        F.lit(220.0).alias("fVoltage"),
        F.lit(70).alias("nTemperature"),
        (F.lit(at("00:00:00")) .cast("timestamp_ntz") + F.make_dt_interval(mins=(15 * F.floor(F.col("id") / 666)).cast("int"))).alias("dtInsert"),
        F.lit(at("00:00:00")).cast("timestamp_ntz").alias("dtLoad"),
    )
    half = F.col("nSourceId") < 666 * 48
    for part in (half, ~half):
        jobs.append_raw(store, store.manifest(INGEST_LOG), day.filter(part))
    assert store.compact(INGEST_LOG, min_batches=2, file_rows=400)
    load(store, reading(100_000, "Machine17", at("12:00:05"), 99, 9.5))
    loaded = store.manifest(INGEST_LOG)
    affected = spark.createDataFrame([("Machine17", at("12:00:00"))], "strMachineName string, dtWindowStart timestamp_ntz")
    for table in ("raw", "partials"):
        every = store.open(table, loaded.batches).inputFiles()
        narrow = jobs._affected_readings(store, loaded, table, affected, 2)
        assert len(every) > 100
        assert len(narrow.inputFiles()) < 0.05 * len(every)
        found = narrow.collect()
        assert sorted(r["fCurrent" if table == "raw" else "fMaximumCurrent"] for r in found) == [1.5, 9.5]
    jobs.refresh_metrics(store, at("23:59:00"), window_minutes=2)
    row = store.metrics().filter("strMachineName = 'Machine17' AND nRecords = 2").first()
    assert (row.fAverageCurrent, row.nMaximumTemperature) == (5.5, 99)


def test_clustered_batches_give_the_same_windows(spark, store):
    rows = many(9, 300)
    for part in (rows[:100], rows[100:200]):
        load(store, *part)
    assert store.compact(INGEST_LOG, min_batches=2, file_rows=10)
    assert store.raw().count() == 200
    load(store, *rows[200:])
    jobs.refresh_metrics(store, at("13:00:00"))
    wanted = keyed(windows.window_metrics(frame(spark, rows)))
    found = {(r.strMachineName, r.dtWindowStart): r for r in store.metrics().collect()}
    assert {k: (r.nRecords, r.nFirstSourceId, r.nLastSourceId, r.fMaximumCurrent) for k, r in found.items()} == {
        k: (r.nRecords, r.nFirstSourceId, r.nLastSourceId, r.fMaximumCurrent) for k, r in wanted.items()
    }
