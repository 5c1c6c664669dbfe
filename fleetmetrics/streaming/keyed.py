"""The refresh as keyed stream state: a cursor and the windows of each machine.

Readings are added up by window inside the map tasks, so a busy machine costs its
task one row per window and batch. The state of a machine keeps every window's
sums, and of the windows with new readings the ids. A processing-time timer wakes
the machine when its next window closes, whether or not a reading follows; a late
reading of any age is added to its window, which goes out again at once.

The rules are those of ``jobs.refresh_metrics`` with the machine's next look as
``as_of``: a look follows each arrival and each closing. Whether a new machine's
reading is recent is settled when it arrives. Sums are doubles, so averages may
differ from the store's in their last bits. State lies in RocksDB and grows by a
row per window.
"""

import time
from collections.abc import Callable, Iterator
from concurrent.futures import Future
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fleetmetrics.functions.clock import minutes, window_start
from fleetmetrics.operators.merge import upsert_control
from fleetmetrics.operators.windows import FIRST_LOAD_BOUND, check_parameters, cover_windows, flag_alerts
from fleetmetrics.schemas import CONTROL, METRICS
from fleetmetrics.session import ship
from fleetmetrics.sources.commits import Conflict
from fleetmetrics.sources.store import REFRESH_LOG, TelemetryStore

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = datetime(1970, 1, 1)
SECOND = 1_000_000

#: What a batch adds to a window, and what the state keeps of it.
_MEASURES = ("Current", "Voltage", "Temperature")
SUMS = ["first", "last", "n", *[f"{part}{m}" for m in _MEASURES for part in ("sum", "min", "max")]]
SUMS_SCHEMA = "first long, last long, n long, " + ", ".join(f"{part}{m} double" for m in _MEASURES for part in ("sum", "min", "max"))
NEW_SCHEMA = f"strMachineName string, start long, {SUMS_SCHEMA}, firstNew long, lastNew long, lastRecent long"
OUT_SCHEMA = f"strMachineName string, start long, {SUMS_SCHEMA}, cursor long, as_of long"

Clock = Callable[[int], datetime]


def _micros(moment: datetime) -> int:
    return (moment - EPOCH) // timedelta(microseconds=1)


def _least(a, b):
    return b if a is None or pd.isna(a) else a if b is None or pd.isna(b) else min(a, b)


def _most(a, b):
    return b if a is None or pd.isna(a) else a if b is None or pd.isna(b) else max(a, b)


def _whole(value) -> int | None:
    return None if value is None or pd.isna(value) else int(value)


def added(old: tuple | None, new: tuple) -> tuple:
    """The sums of a window with those of a batch."""
    if old is None:
        return new
    made = dict(zip(SUMS, old, strict=True))
    for name, value in zip(SUMS, new, strict=True):
        if name.startswith(("first", "min")):
            made[name] = min(made[name], value)
        elif name.startswith(("last", "max")):
            made[name] = max(made[name], value)
        else:
            made[name] += value
    return tuple(made[name] for name in SUMS)


def _combined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per machine and window of each batch."""
    how = {"first": ("id", "min"), "last": ("id", "max"), "n": ("id", "size")}
    for m in _MEASURES:
        how |= {f"sum{m}": (m, "sum"), f"min{m}": (m, "min"), f"max{m}": (m, "max")}
    how |= {"firstNew": ("own", "min"), "lastNew": ("own", "max"), "lastRecent": ("recent", "max")}
    for frame in frames:
        made = frame.groupby(["strMachineName", "start"], as_index=False).agg(**how)
        yield made.astype({c: "Int64" for c in ("firstNew", "lastNew", "lastRecent")})


class WindowKeeper(StatefulProcessor):
    """One machine: its windows, those with new readings, and its cursor."""

    def __init__(self, window_minutes: int, watermark_seconds: int, clock: Clock):
        self.length = window_minutes * 60 * SECOND
        self.delay = watermark_seconds * SECOND
        self.clock = clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", SUMS_SCHEMA)
        self.pending = handle.getMapState("pending", "start long", "first long, last long, recent long")
        self.cursor = handle.getValueState("cursor", "id long")
        self.alarm = handle.getValueState("alarm", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for row in frame.itertuples(index=False):
                place = (int(row.start),)
                old = self.windows.getValue(place) if self.windows.containsKey(place) else None
                new = tuple(int(getattr(row, c)) if c in ("first", "last", "n") else float(getattr(row, c)) for c in SUMS)
                self.windows.updateValue(place, added(old, new))
                own = [_whole(v) for v in (row.firstNew, row.lastNew, row.lastRecent)]
                if own[1] is not None:
                    known = self.pending.getValue(place) if self.pending.containsKey(place) else (None, None, None)
                    self.pending.updateValue(place, (_least(known[0], own[0]), _most(known[1], own[1]), _most(known[2], own[2])))
        yield from self.look(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.clear()
        yield from self.look(key, timerValues)

    def look(self, key, timerValues) -> Iterator[pd.DataFrame]:
        """The closed windows with ids past the cursor; sets the cursor and the next timer."""
        wall = timerValues.getCurrentProcessingTimeInMs()
        now = _micros(self.clock(wall))
        cursor = self.cursor.get()[0] if self.cursor.exists() else None
        pending = {place[0]: ids for place, ids in self.pending.iterator()}
        closed = {s for s in pending if s + self.length + self.delay <= now}
        due = {}
        for start in closed:
            _, last, recent = pending[start]
            due[start] = recent if cursor is None else last if last > cursor else None
        due = {start: last for start, last in due.items() if last is not None}
        if due:
            cursor = max(due.values()) if cursor is None else max(cursor, *due.values())
            self.cursor.update((cursor,))
        again = False
        for start in closed:
            if cursor is not None and pending[start][1] <= cursor:
                self.pending.removeKey((start,))
            elif cursor is not None:
                again = True  # ids past the first cursor, from before the first-load bound
        waiting = [s for s in pending if s not in closed]
        if again or waiting:
            wait = 0 if again else (min(waiting) + self.length + self.delay - now) // 1000 + 1
            self.wake(wall + max(int(wait), 1))
        if due:
            rows = [(key[0], s, *self.windows.getValue((s,)), cursor, now) for s in sorted(due)]
            yield pd.DataFrame(rows, columns=["strMachineName", "start", *SUMS, "cursor", "as_of"])

    def wake(self, at: int) -> None:
        """One timer at a time, the earliest."""
        if self.alarm.exists():
            set_for = self.alarm.get()[0]
            if set_for <= at:
                return
            self.handle.deleteTimer(set_for)
        self.handle.registerTimer(at)
        self.alarm.update((at,))

    def close(self) -> None:
        pass


def keyed_windows(readings: DataFrame, clock: Clock, window_minutes: int = 2, watermark_seconds: int = 15) -> DataFrame:
    """Rows of OUT_SCHEMA from a stream of raw readings.

    ``clock`` gives the site's time of a wall-clock moment in milliseconds; it
    runs on the workers.
    """
    placed = cover_windows(readings, window_minutes)
    mine = window_start(F.col("dtInsert"), window_minutes) == F.col("dtWindowStart")
    names = {"Current": "fCurrent", "Voltage": "fVoltage", "Temperature": "nTemperature"}
    event = F.unix_micros(F.col("dtInsert").cast("timestamp"))
    sent = placed.select(
        "strMachineName",
        F.unix_micros(F.col("dtWindowStart").cast("timestamp")).alias("start"),
        F.col("nSourceId").alias("id"),
        F.when(mine, F.col("nSourceId")).alias("own"),
        event.alias("event"),
        *[F.col(c).cast("double").alias(m) for m, c in names.items()],
    )
    bound = FIRST_LOAD_BOUND // timedelta(microseconds=1)

    def combined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def marked() -> Iterator[pd.DataFrame]:
            for frame in frames:
                now = _micros(clock(int(time.time() * 1000)))
                yield frame.assign(recent=frame["own"].where(frame["event"] >= now - bound))

        yield from _combined(marked())

    ship(readings.sparkSession)
    keeper = WindowKeeper(window_minutes, watermark_seconds, clock)
    grouped = sent.mapInPandas(combined, NEW_SCHEMA).groupBy("strMachineName")
    return grouped.transformWithStateInPandas(keeper, OUT_SCHEMA, "Update", "ProcessingTime")


def _metrics(out: DataFrame, window_minutes: int, threshold: int) -> DataFrame:
    start = F.timestamp_micros("start").cast("timestamp_ntz")
    columns = {
        "nFirstSourceId": F.col("first"),
        "nLastSourceId": F.col("last"),
        "dtWindowStart": start,
        "dtWindowEnd": start + minutes(window_minutes),
        "nRecords": F.col("n").cast("int"),
        "dtProcessing": F.timestamp_micros("as_of").cast("timestamp_ntz"),
    }
    for m in _MEASURES:
        kind, whole = ("n", "int") if m == "Temperature" else ("f", "double")
        columns |= {
            f"fAverage{m}": F.col(f"sum{m}") / F.col("n"),
            f"{kind}Minimum{m}": F.col(f"min{m}").cast(whole),
            f"{kind}Maximum{m}": F.col(f"max{m}").cast(whole),
        }
    return flag_alerts(out.withColumns(columns), threshold).select(*METRICS.fieldNames())


def commit_windows(store: TelemetryStore, out: DataFrame, source: str, batch_id: int, window_minutes: int, threshold: int) -> int:
    """Write what a micro-batch has given out, once; returns the number of windows."""
    out = out.persist()
    try:
        while True:
            refreshed = store.manifest(REFRESH_LOG)
            if batch_id <= refreshed.state.get("sources", {}).get(source, -1) or out.isEmpty():
                return 0
            number = store.claim(REFRESH_LOG, refreshed)
            control = store.control(refreshed)
            store.write("metrics", _metrics(out, window_minutes, threshold), number)
            moved = out.groupBy("strMachineName").agg(
                F.max("cursor").alias("nLastProcessedSourceId"),
                F.timestamp_micros(F.max("as_of")).cast("timestamp_ntz").alias("dtLastProcessing"),
            )
            store.write("control", upsert_control(control, moved.select(*CONTROL.fieldNames())), number)
            batch, found = store.describe("metrics", number)
            state = {"control": number, "sources": {**refreshed.state.get("sources", {}), source: batch_id}}
            try:
                store.commit(REFRESH_LOG, refreshed.extended(*([batch] if batch else []), used=number, **state))
                return found["rows"]
            except Conflict:
                continue
    finally:
        out.unpersist()


def stream_keyed_refresh(
    readings: DataFrame,
    store: TelemetryStore,
    checkpoint: str,
    clock: Clock,
    trigger: dict | None = None,
    window_minutes: int = 2,
    watermark_seconds: int = 15,
    threshold: int = 85,
) -> StreamingQuery:
    """Metrics and cursors from a stream of raw readings, closed by timers.

    The query's own id and micro-batch numbers make a replayed batch count once.
    """
    check_parameters(window_minutes, watermark_seconds)
    spark = readings.sparkSession
    source: Future[str] = Future()

    def write(out: DataFrame, batch_id: int) -> None:
        commit_windows(store, out, source.result(), batch_id, window_minutes, threshold)

    windows = keyed_windows(readings, clock, window_minutes, watermark_seconds)
    trigger = trigger or {"processingTime": "10 seconds"}
    # With timers there is always another batch to run; a run of what is there now has to end.
    settings = {PROVIDER: ROCKSDB, EMPTY_BATCHES: str("availableNow" not in trigger).lower()}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        writer = windows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        query = writer.trigger(**trigger).start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    source.set_result(f"keyed:{query.id}")
    return query
