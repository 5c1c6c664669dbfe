"""Two writers of one log: conflicts are seen, and the outcome is that of one writer."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from model import LOAD, at, frame, reading, stored_control, stored_metrics

from fleetmetrics.plans import jobs
from fleetmetrics.sources.commits import KEEP, Conflict, NumberedFiles
from fleetmetrics.sources.store import INGEST_LOG, READINGS_LOG, REFRESH_LOG, Manifest, TelemetryStore

GOOD = '{"strMachineName":"M1","fA":%d,"fV":220,"nTemperature":84.5,"dtNow":"2024-01-01 10:00:00"}'


def texts(spark, numbers):
    return spark.createDataFrame([(GOOD % n,) for n in numbers], "value string")


def before_first_commit(store, monkeypatch, log, other):
    """Runs `other` on a second store just before the first commit to the log."""
    real, ran = store.commit, []

    def commit(which, manifest):
        if which == log and not ran:
            ran.append(1)
            other(TelemetryStore(store.spark, store.root))
        real(which, manifest)

    monkeypatch.setattr(store, "commit", commit)
    return ran


def append(store, rows):
    return jobs.append_raw(store, store.manifest(INGEST_LOG), frame(store.spark, rows))


def test_a_number_is_written_once(spark, folder):
    files = NumberedFiles(spark, folder, "x")
    assert files.newest() is None
    files.put(3, "three")
    with pytest.raises(Conflict):
        files.put(3, "other")
    assert files.newest() == (3, "three")
    assert files.numbers() == [3]


def test_of_many_threads_one_wins(spark, folder):
    def attempt(i):
        try:
            NumberedFiles(spark, folder, "x").put(1, str(i))
            return i
        except Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(attempt, range(24)) if i is not None]
    assert len(won) == 1
    assert NumberedFiles(spark, folder, "x").newest() == (1, str(won[0]))


def test_low_numbers_are_not_taken_again(spark, folder):
    files = NumberedFiles(spark, folder, "x")
    for i in range(KEEP + 5):
        files.put_next(i, str(i))
    assert len(files.numbers()) == KEEP
    with pytest.raises(Conflict):
        files.put_next(2, "late")
    assert files.newest() == (KEEP + 4, str(KEEP + 4))


def test_claims_are_never_shared(spark, store):
    manifest = Manifest()
    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(lambda _: store.claim(INGEST_LOG, manifest), range(12)))
    assert sorted(ids) == list(range(1, 13))


def test_overlapping_ingests_end_as_one_writer_would(spark, store, monkeypatch):
    mine = [reading(i, "M", at("10:00:00")) for i in range(1, 7)]
    other = [reading(i, "M", at("10:00:00")) for i in range(4, 10)]
    ran = before_first_commit(store, monkeypatch, INGEST_LOG, lambda s: append(s, other))
    assert append(store, mine) == 3
    assert ran and sorted(r.nSourceId for r in store.raw().collect()) == list(range(1, 10))
    jobs.refresh_metrics(store, at("11:00:00"))
    assert stored_metrics(store)["M", at("10:00:00"), at("10:02:00")][:3] == (1, 9, 9)
    assert store.manifest(INGEST_LOG).ids == [[1, 2]]


def test_ingests_apart_are_not_written_again(spark, store, monkeypatch):
    mine = [reading(i, "M", at("10:00:00")) for i in range(1, 4)]
    other = [reading(i, "M", at("10:00:00")) for i in range(10, 12)]
    before_first_commit(store, monkeypatch, INGEST_LOG, lambda s: append(s, other))
    written, real = [], store.write
    monkeypatch.setattr(store, "write", lambda table, rows, i: (written.append(table), real(table, rows, i)))
    assert append(store, mine) == 3
    assert written.count("raw") == 1
    assert store.raw().count() == 5
    assert store.manifest(INGEST_LOG).state["cursor"] == 11


def test_all_rows_already_loaded_by_the_other(spark, store, monkeypatch):
    rows = [reading(i, "M", at("10:00:00")) for i in range(1, 4)]
    before_first_commit(store, monkeypatch, INGEST_LOG, lambda s: append(s, rows))
    assert append(store, rows) == 0
    assert store.raw().count() == 3


def test_receivers_number_their_messages_one_after_the_other(spark, store, monkeypatch):
    before_first_commit(store, monkeypatch, READINGS_LOG, lambda s: jobs.receive_messages(s, texts(spark, [7, 8]), "b", 0))
    mixed = texts(spark, [1, 2]).union(spark.createDataFrame([("broken",)], "value string"))
    assert jobs.receive_messages(store, mixed, "a", 0) == 2
    assert sorted((r.nId, r.fA) for r in store.buffer().collect())[:2] == [(1, 7.0), (2, 8.0)]
    assert sorted(r.nId for r in store.buffer().collect()) == [1, 2, 3, 4]
    assert store.quarantine().count() == 1
    assert jobs.ingest(store, LOAD).inserted == 4


def test_one_source_batch_received_twice_at_once(spark, store, monkeypatch):
    before_first_commit(store, monkeypatch, READINGS_LOG, lambda s: jobs.receive_messages(s, texts(spark, [1, 2]), "a", 0))
    assert jobs.receive_messages(store, texts(spark, [1, 2]), "a", 0) == 0
    assert store.buffer().count() == 2


def test_overtaken_refresh_starts_again(spark, store, monkeypatch):
    append(store, [reading(1, "M", at("10:00:00")), reading(2, "N", at("10:00:00"))])
    before_first_commit(store, monkeypatch, REFRESH_LOG, lambda s: jobs.refresh_metrics(s, at("11:00:00")))
    assert jobs.refresh_metrics(store, at("11:02:00")) == jobs.RefreshCounts(0, 0)
    assert {r[-1] for r in stored_metrics(store).values()} == {at("11:00:00")}
    assert set(stored_control(store)) == {"M", "N"}


def test_compaction_gives_way_or_goes_on(spark, store, monkeypatch):
    for i in range(1, 4):
        append(store, [reading(i, "M", at("10:00:00"))])
    before_first_commit(store, monkeypatch, INGEST_LOG, lambda s: append(s, [reading(9, "M", at("10:00:00"))]))
    assert store.compact(INGEST_LOG, min_batches=2)
    assert sorted(r.nSourceId for r in store.raw().collect()) == [1, 2, 3, 9]
    monkeypatch.undo()
    before_first_commit(store, monkeypatch, INGEST_LOG, lambda s: s.compact(INGEST_LOG, min_batches=2))
    assert not store.compact(INGEST_LOG, min_batches=2)
    assert sorted(r.nSourceId for r in store.raw().collect()) == [1, 2, 3, 9]
