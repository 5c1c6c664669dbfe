"""Arrival ids, cursor, idempotent append and the receive and ingest jobs."""

from datetime import timedelta

import pytest
from model import LOAD, at, frame, reading
from pyspark.sql import functions as F

from fleetmetrics.operators import ingest as ops
from fleetmetrics.plans import jobs
from fleetmetrics.sources.readers import buffer_options, landing_files
from fleetmetrics.sources.store import INGEST_LOG, READINGS_LOG

GOOD = (
    '{"strMachineName":"M1","fA":%d,"fV":220,"nTemperature":84.5,"dtNow":"2024-01-01 10:00:00"}'
)


def texts(spark, numbers):
    return spark.createDataFrame([(GOOD % n,) for n in numbers], "value string")


def test_ids_are_dense_and_do_not_depend_on_the_split(spark, folder):
    spark.range(0, 5_000, 1, 6).withColumn("x", F.col("id") * 2).write.parquet(folder)
    found = []
    for split in ("128m", "8k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        stored = spark.read.parquet(folder)
        numbered = ops.assign_source_ids(stored, base=10)
        found.append({(r.nId, r.id) for r in numbered.collect()})
        assert numbered.columns == ["nId", "id", "x"]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1]
    assert {n for n, _ in found[0]} == set(range(11, 5_011))


def test_many_files_take_the_plain_join(spark, folder, monkeypatch):
    spark.range(0, 100, 1, 4).write.parquet(folder)
    monkeypatch.setattr(ops, "BROADCAST_FILES", 1)
    numbered = ops.assign_source_ids(spark.read.parquet(folder), base=0)
    assert {r.nId for r in numbered.collect()} == set(range(1, 101))


def test_cursor_of_an_empty_table_is_zero(spark):
    assert ops.ingest_cursor(frame(spark, [])).first()[0] == 0
    assert ops.ingest_cursor(frame(spark, [reading(7, "M", at("10:00:00"))])).first()[0] == 7


def test_append_inserts_each_key_once(store):
    rows = [reading(1, "M", at("10:00:00")), reading(2, "M", at("10:00:02"))]

    def load(some):
        return jobs.append_raw(store, store.manifest(INGEST_LOG), frame(store.spark, some))

    assert load(rows + rows[:1]) == 2
    assert load(rows + [reading(2, "N", at("10:00:02"))]) == 1
    assert load([]) == 0
    keys = sorted((r.nSourceId, r.strMachineName) for r in store.raw().collect())
    assert keys == [(1, "M"), (2, "M"), (2, "N")]


def test_messages_flow_to_raw_once(spark, store):
    mixed = texts(spark, [1, 2]).union(spark.createDataFrame([("broken",)], "value string"))
    assert jobs.receive_messages(store, mixed, "s", 0) == 2
    assert jobs.receive_messages(store, mixed, "s", 0) == 0
    assert jobs.ingest(store, LOAD) == jobs.IngestCounts(2, 2)
    assert jobs.ingest(store, LOAD) == jobs.IngestCounts(0, 0)
    assert jobs.receive_messages(store, texts(spark, [3]), "s", 1) == 1
    assert jobs.receive_messages(store, texts(spark, []), "s", 2) == 0
    assert jobs.receive_messages(store, texts(spark, [4]), "other", 0) == 1
    assert jobs.ingest(store, LOAD) == jobs.IngestCounts(2, 2)
    raw = {r.nSourceId: r for r in store.raw().collect()}
    assert sorted(raw) == [1, 2, 3, 4]
    assert sorted(r.fCurrent for r in raw.values()) == [1.0, 2.0, 3.0, 4.0]
    assert {r.nTemperature for r in raw.values()} == {85}
    assert {r.dtLoad for r in raw.values()} == {LOAD}
    assert [tuple(r) for r in store.quarantine().collect()] == [("broken", "invalid_json", None)]


def test_failed_receive_is_repeated_without_gaps(spark, store, monkeypatch):
    real = store.commit

    def fail(log, manifest):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "commit", fail)
    try:
        jobs.receive_messages(store, texts(spark, [1, 2]), "s", 0)
    except RuntimeError:
        pass
    monkeypatch.setattr(store, "commit", real)
    assert store.buffer().count() == 0 and store.quarantine().count() == 0
    jobs.receive_messages(store, texts(spark, [1, 2]), "s", 0)
    assert sorted(r.nId for r in store.buffer().collect()) == [1, 2]


def test_buffer_compaction_keeps_ids_and_the_cursor(spark, store):
    for i in range(3):
        jobs.receive_messages(store, texts(spark, [i]), "s", i)
    before = sorted(map(tuple, store.buffer().collect()))
    assert store.compact(READINGS_LOG, min_batches=2)
    assert sorted(map(tuple, store.buffer().collect())) == before
    assert jobs.receive_messages(store, texts(spark, [9]), "s", 3) == 1
    assert jobs.ingest(store, LOAD).inserted == 4
    assert store.quarantine().count() == 0


def test_landing_files_are_lines(spark, folder):
    texts(spark, [1, 2, 3]).coalesce(1).write.text(folder)
    assert landing_files(spark, folder).count() == 3


def test_buffer_options_bound_the_scan():
    options = buffer_options("jdbc:sqlite:/x.db", "SensorData", 10, 500, 4)
    assert "nId > 10" in options["dbtable"]
    assert (options["lowerBound"], options["upperBound"]) == ("11", "500")


def buffer_of_text(spark, rows):
    columns = "nId long, strMachineName string, fA string, fV string, nTemperature string, dtInsert string"
    return spark.createDataFrame(rows, columns)


def test_text_buffer_is_converted_and_breakers_are_kept_out(spark, store):
    good = "2024-01-01 10:00:00"
    rows = [
        (1, "M", "1.5", "220", "84.5", good),
        (2, "M", "1", "220", "80", "not a date"),
        (3, None, "1", "220", "80", good),
        (4, "M", None, "220", "80", good),
        (5, "M", "1", "220", "3e9", good),
        (6, "M" * 101, "1", "220", "80", good),
        (7, "M", "1", "x", "-2147483648", good),
        (8, "M", "1", "2", "-2147483648", "2024-01-01 10:00:01.25"),
        (9, "M", "1", "2", None, good),
    ]
    assert jobs.ingest(store, LOAD, buffer_of_text(spark, rows)) == jobs.IngestCounts(9, 2, 7)
    raw = {r.nSourceId: r for r in store.raw().collect()}
    assert sorted(raw) == [1, 8]
    assert raw[1].nTemperature == 85 and raw[1].dtInsert == at("10:00:00")
    assert raw[8].nTemperature == -2147483648
    fields = sorted(r.reject_field for r in store.quarantine().collect())
    assert fields == ["dtInsert", "fCurrent", "fVoltage", "nTemperature", "nTemperature", "strMachineName", "strMachineName"]
    assert jobs.ingest(store, LOAD, buffer_of_text(spark, rows)) == jobs.IngestCounts(0, 0)
    assert jobs.refresh_metrics(store, at("11:00:00")).processed_metrics == 1
    assert store.metrics().first().bTemperatureAlert is True


def test_only_breakers_still_move_the_cursor(spark, store):
    rows = [(5, None, "1", "2", "3", "2024-01-01 10:00:00")]
    assert jobs.ingest(store, LOAD, buffer_of_text(spark, rows)) == jobs.IngestCounts(1, 0, 1)
    assert jobs.ingest(store, LOAD, buffer_of_text(spark, rows)) == jobs.IngestCounts(0, 0)
    assert store.quarantine().count() == 1


def test_wrong_columns_are_refused_before_writing(spark, store):
    rows = frame(spark, [reading(1, "M", at("10:00:00"))])
    with pytest.raises(TypeError, match="dtInsert"):
        store.write("raw", rows.withColumn("dtInsert", F.col("dtInsert").cast("string")), 1)


def test_quarantine_reads_any_number_of_batches(spark, store):
    """Compactions take ids in between; what they leave behind stays out."""
    for i in range(6):
        mixed = texts(spark, [i]).union(spark.createDataFrame([("broken",)], "value string"))
        jobs.receive_messages(store, mixed, "s", i)
        if i % 2:
            died = store.manifest(READINGS_LOG).next_id
            store.written("staged", 1).drop("batch_id").write.partitionBy("rejected").parquet(store.path("staged", died))
            assert store.compact(READINGS_LOG, min_batches=2)
    assert store.quarantine().count() == 6
    depth = store.quarantine()._jdf.queryExecution().optimizedPlan().toString()
    assert depth.count("batch_id#") < 20


def test_small_loads_are_merged_and_expire(spark, store):
    for i in range(40):
        jobs.receive_messages(store, texts(spark, [i]), "s", i)
    batches = store.manifest(READINGS_LOG).batches
    assert len(batches) < 33 and sum(b.rows for b in batches) == 40
    gone = store.expire(READINGS_LOG, timedelta(0))
    assert len(gone) >= 32 + 40
    assert store.expire(READINGS_LOG, timedelta(0)) == []
    assert sorted(r.nId for r in store.buffer().collect()) == list(range(1, 41))
    assert jobs.ingest(store, LOAD).inserted == 40
    assert store.expire(INGEST_LOG, timedelta(days=1)) == []


def test_old_runs_of_small_batches_are_merged_too(spark, store):
    for i in range(5):
        rows = [reading(100 * i + k, "M", at("10:00:00")) for k in range(50 if i == 3 else 1)]
        jobs.append_raw(store, store.manifest(INGEST_LOG), frame(spark, rows))
    assert store.compact(INGEST_LOG, max_rows=20, min_batches=3)
    assert sorted(b.rows for b in store.manifest(INGEST_LOG).batches) == [1, 3, 50]
    assert store.raw().count() == 54

