"""The batch jobs: receive messages, ingest, refresh metrics."""

from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmetrics.functions.clock import minutes, ntz
from fleetmetrics.operators import intervals, partials
from fleetmetrics.operators.decode import CONSTRAINT, classify_messages
from fleetmetrics.operators.ingest import (
    assign_source_ids,
    idempotent_append,
    incremental_scan,
    load_readings,
    raw_violation,
)
from fleetmetrics.operators.merge import stamp_cursors, upsert_control
from fleetmetrics.operators.windows import (
    FIRST_LOAD_BOUND,
    MAX_CLOSED,
    WINDOW_KEY,
    check_parameters,
    closed_windows,
    cursor_updates,
    flag_alerts,
    pending_against,
    recompute_windows,
    stamp_metrics,
    successful_machines,
    window_pending,
)
from fleetmetrics.schemas import BUFFER, CONTROL, RAW, RAW_KEY
from fleetmetrics.session import empty
from fleetmetrics.sources.commits import Conflict
from fleetmetrics.sources.store import (
    INGEST_LOG,
    READINGS_LOG,
    REFRESH_LOG,
    TIME_COLUMN,
    Batch,
    Manifest,
    TelemetryStore,
)

# Days with affected windows up to which their time bounds are pushed into the
# scan; with more, whole days are picked while the query runs. No other day is
# read either way.
PUSHED_DAYS = 200
# Affected windows up to which the files that hold them are looked up in the zone
# map, and files up to which they are opened by name.
NARROW_WINDOWS = 1000
NARROW_FILES = 4000
# Ranges of ids that two loads may share up to which they are pushed into the scan.
SHARED_RANGES = 200
# Readings further ahead than this are left to the scan of their own date.
NEAR_FUTURE = timedelta(days=1)


@dataclass(frozen=True)
class IngestCounts:
    found: int
    inserted: int
    rejected: int = 0


@dataclass(frozen=True)
class RefreshCounts:
    processed_metrics: int
    updated_machines: int


# -- messages -> buffer -------------------------------------------------------


def _already_done(manifest: Manifest, source: str, source_batch: int) -> bool:
    return source_batch <= manifest.state.get("sources", {}).get(source, -1)


def receive_messages(
    store: TelemetryStore,
    messages: DataFrame,
    source: str,
    source_batch: int,
    value: str = "value",
) -> int:
    """Decode messages into the buffer and the quarantine; returns rows accepted.

    One write holds both outcomes. The accepted rows are numbered from the
    written files, so a repeated task cannot change an id. A source numbers
    its batches upwards; one that is already in the log is skipped, so the same
    messages given twice under one number count once.
    """
    manifest = store.manifest(READINGS_LOG)
    if _already_done(manifest, source, source_batch):
        return 0
    batch_id = store.claim(READINGS_LOG, manifest)
    classified = classify_messages(messages.select(F.col(value).cast("string").alias("value")))
    rejected = F.col("reject_reason").isNotNull()
    text = F.when(rejected, F.col("value"))
    staged = classified.withColumns({"rejected": rejected, "value": text})
    staged.write.mode("overwrite").partitionBy("rejected").parquet(store.path("staged", batch_id))

    accepted = store.written("staged", batch_id).filter(~F.col("rejected"))
    accepted = accepted.select(*BUFFER.fieldNames()[1:])
    while True:
        base = max(manifest.max_id, manifest.state.get("max_id", 0))
        store.write("buffer", assign_source_ids(accepted, base), batch_id)
        added, found = store.describe("buffer", batch_id)
        state = {
            "staged": True,
            "sources": {**manifest.state.get("sources", {}), source: source_batch},
            "max_id": base + found["rows"],
        }
        batches = [added] if added else []
        try:
            _commit(store, READINGS_LOG, manifest.extended(*batches, used=batch_id, **state))
            return found["rows"]
        except Conflict:  # another source came first: the ids follow its own
            manifest = store.manifest(READINGS_LOG)
            if _already_done(manifest, source, source_batch):
                return 0


# -- buffer -> raw ------------------------------------------------------------


def _commit(store: TelemetryStore, log: str, manifest: Manifest) -> None:
    """Commit, and merge small batches when enough have gathered."""
    store.commit(log, manifest)
    store.compact(log, manifest=manifest)


def _extent(rows: DataFrame):
    """Count and id range of typed rows, and how many the raw table refuses."""
    source = F.col("nSourceId")
    return rows.agg(
        F.count("*").alias("found"),
        F.min(source).alias("low"),
        F.max(source).alias("high"),
        F.count_if(raw_violation().isNotNull()).alias("refused"),
    ).first()


def _shared_ranges(store: TelemetryStore, overlapping: tuple[Batch, ...], rows: DataFrame, gap: int) -> list[tuple[int, int]]:
    """Ranges of ids outside which no row can be in the given batches."""
    known = tuple(b for b in overlapping if b.runs)
    ranges = [(b.min_id, b.max_id) for b in overlapping if not b.runs]
    if known:
        stored = store.open("runs", known).select(*intervals.RUNS.fieldNames())
        ranges += intervals.id_ranges(intervals.shared_runs(intervals.id_runs(rows, gap), stored), SHARED_RANGES)
    ranges = intervals.joined_ranges(ranges)
    return ranges if len(ranges) <= SHARED_RANGES else [(ranges[0][0], ranges[-1][1])]


def _not_loaded(store: TelemetryStore, overlapping: tuple[Batch, ...], rows: DataFrame, gap: int) -> DataFrame:
    """One row per key that the given batches do not hold.

    Rows are compared in the shared ranges of ids only; the others are new. Without such a
    range no batch is read.
    """
    ranges = _shared_ranges(store, overlapping, rows, gap)
    if not ranges:
        return rows.dropDuplicates(RAW_KEY)
    inside = reduce(or_, [F.col("nSourceId").between(*r) for r in ranges])
    reached = tuple(b for b in overlapping if any(b.min_id <= high and b.max_id >= low for low, high in ranges))
    near = idempotent_append(store.open("raw", reached).filter(inside), rows.filter(inside))
    return near.unionByName(rows.filter(~inside).dropDuplicates(RAW_KEY))


def append_raw(
    store: TelemetryStore,
    manifest: Manifest,
    rows: DataFrame,
    extent=None,
    numbered: bool = False,
    gap: int = intervals.GAP,
) -> int:
    """Insert rows not yet in the raw table; returns the inserted count.

    ``numbered`` says that the store itself gave the ids, so that no two rows
    share one; new ids then need no comparison and no shuffle.

    Only raw batches that reach into the rows' id range are looked at, and of those
    the runs of ids first: rows are joined where a machine's runs meet. Gaps above
    ``gap`` ids part two runs. After an incremental scan there are no such batches,
    and the plan has no join. Rows that break
    a rule of the table go to the quarantine, and the cursor passes them. Several
    writers may append at once: whoever commits second compares its rows with
    those of the first.
    """
    extent = extent or _extent(rows)
    if not extent.found:
        return 0
    low, high = extent.low or 0, extent.high or 0
    batch_id = store.claim(INGEST_LOG, manifest)
    if extent.refused:
        refused = rows.withColumn("reject_field", raw_violation()).filter("reject_field IS NOT NULL")
        body = F.to_json(F.struct(*RAW.fieldNames()), {"ignoreNullFields": "false"})
        store.write(
            "rejected",
            refused.select(body.alias("value"), F.lit(CONSTRAINT).alias("reject_reason"), "reject_field"),
            batch_id,
        )
        rows = rows.filter(raw_violation().isNull())
    seen: Manifest | None = None
    while True:
        overlapping = tuple(b for b in manifest.batches if b.max_id >= low and b.min_id <= high)
        known = set(seen.batches) if seen else set()
        if seen is None or any(b not in known for b in overlapping):
            fresh = rows if numbered and not overlapping else _not_loaded(store, overlapping, rows, gap)
            store.write("raw", fresh.select(*RAW.fieldNames()), batch_id)
            inexact = F.count_if(partials.inexact()).alias("inexact")
            added, found = store.describe("raw", batch_id, inexact)
            if added:
                store.write_partials(batch_id)
            # The store's own ids never come twice, so their runs are not needed.
            if added and not numbered:
                store.write_runs(batch_id, gap)
                added = replace(added, runs=True)
        if not added and not extent.refused:
            return 0
        state = {"cursor": max(high, manifest.state.get("cursor", 0))}
        if extent.refused:
            state["rejected"] = True
        # Minutes are summed up from the first load on.
        if not manifest.batches or manifest.state.get("partials"):
            state["partials"] = True
        if found["inexact"]:
            state["inexact"] = True
        batches = [added] if added else []
        try:
            _commit(store, INGEST_LOG, manifest.extended(*batches, used=batch_id, **state))
            return found["rows"]
        except Conflict:  # what was written stands unless new batches reach into its ids
            seen, manifest = manifest, store.manifest(INGEST_LOG)


def ingest(store: TelemetryStore, as_of: datetime, source: DataFrame | None = None) -> IngestCounts:
    """Copy buffer rows after the cursor to the raw table.

    The cursor comes from the manifest, not from a scan of the raw table.
    ``source`` replaces the store's own buffer; its numbers and dates may be text.
    """
    manifest = store.manifest(INGEST_LOG)
    cursor = max(manifest.max_id, manifest.state.get("cursor", 0))
    own = source is None
    if own:
        fresh = tuple(b for b in store.manifest(READINGS_LOG).batches if b.max_id > cursor)
        source = store.open("buffer", fresh)
    loaded = load_readings(incremental_scan(source, cursor), as_of)
    extent = _extent(loaded)
    inserted = append_raw(store, manifest, loaded, extent, numbered=own)
    return IngestCounts(extent.found, inserted, extent.refused)


# -- raw -> metrics -----------------------------------------------------------


def _candidate_scan(
    store: TelemetryStore,
    loaded: Manifest,
    refreshed: Manifest,
    as_of: datetime,
    window_minutes: int,
) -> DataFrame:
    """A superset of the candidate readings that does not grow with history.

    Every reading that could still move a cursor has an id at or above the
    last refresh's low-water mark, or came in later, or lay more than a day in
    the future back then. Without such a mark, or when the clock was set back,
    everything is scanned; with no cursors at all, only the first-load bound.
    """
    state = refreshed.state
    if "as_of" not in state or as_of < datetime.fromisoformat(state["as_of"]):
        rows = store.open("raw", loaded.batches)
        if "control" in state:
            return rows
        bound = as_of - FIRST_LOAD_BOUND
        return rows.filter(
            (F.col("event_date") >= F.lit(bound.date())) & (F.col("dtInsert") >= ntz(bound))
        )
    low, seen = state["low_water"], state["loaded"]
    # Two scans, so that the id bound of the second reaches Parquet statistics:
    # a compacted batch that reaches the mark is not read whole.
    loads = store.open("raw", tuple(b for b in loaded.batches if b.origin > seen))
    reaching = tuple(b for b in loaded.batches if b.origin <= seen and b.max_id >= low)
    recent = loads.unionByName(store.open("raw", reaching).filter(F.col("nSourceId") >= low))

    since = datetime.fromisoformat(state["as_of"]) + NEAR_FUTURE
    until = as_of + NEAR_FUTURE + timedelta(minutes=window_minutes)
    days = (since.date(), until.date())
    ahead = store.open(
        "raw",
        tuple(
            b
            for b in loaded.batches
            if b.origin <= seen
            and b.min_id < low
            and b.first_date <= days[1].isoformat()
            and b.last_date >= days[0].isoformat()
        ),
    ).filter(
        F.col("event_date").between(F.lit(days[0]), F.lit(days[1]))
        & (F.col("dtInsert") > ntz(since))
        & (F.col("dtInsert") < ntz(until))
        & (F.col("nSourceId") < low)
    )
    return recent.unionByName(ahead)


def _affected_days(affected: DataFrame, window_minutes: int) -> DataFrame:
    """A row per day that an affected window touches, with the windows' bounds on it."""
    start = F.col("dtWindowStart")
    end = start + minutes(window_minutes)
    last = F.to_date(end - F.expr("INTERVAL '0.000001' SECOND"))
    days = affected.select(
        start.alias("low"), end.alias("high"), F.explode(F.sequence(F.to_date(start), last)).alias("day")
    )
    return days.groupBy("day").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _in_days(rows: DataFrame, days: DataFrame, bounds: list, time: str) -> DataFrame:
    """Rows of a dated table within the days' bounds; ``bounds`` are the collected days."""
    day = "event_date"
    if len(bounds) > PUSHED_DAYS:
        picked = days.select(F.col("day").alias(day), "low", "high")
        inside = (F.col(time) >= F.col("low")) & (F.col(time) < F.col("high"))
        return rows.join(F.broadcast(picked), day).filter(inside).select(*rows.columns)
    wanted = F.lit(False)
    for bound in bounds:
        wanted = wanted | (
            (F.col(day) == F.lit(bound.day)) & (F.col(time) >= ntz(bound.low)) & (F.col(time) < ntz(bound.high))
        )
    return rows.filter(wanted)


def _prune_to_windows(
    readings: DataFrame, affected: DataFrame, window_minutes: int
) -> DataFrame | None:
    """Readings of the days and hours of the affected windows; None without any.

    The driver sees one row per affected day.
    """
    days = _affected_days(affected, window_minutes)
    bounds = days.collect()
    return _in_days(readings, days, bounds, "dtInsert") if bounds else None


def _affected_readings(
    store: TelemetryStore, loaded: Manifest, table: str, affected: DataFrame, window_minutes: int
) -> DataFrame | None:
    """Rows of a dated table that may lie in the affected windows; None without any.

    With few affected windows, clustered batches are read by the files that their
    zone map names; all else goes by days and hours.
    """
    time = TIME_COLUMN[table]
    days = _affected_days(affected, window_minutes)
    bounds = days.collect()
    if not bounds:
        return None
    clustered = tuple(b for b in loaded.batches if b.clustered)
    if clustered:
        few = affected.select(*WINDOW_KEY).limit(NARROW_WINDOWS + 1).collect()
        if len(few) <= NARROW_WINDOWS:
            schema = affected.select(*WINDOW_KEY).schema
            known = store.spark.createDataFrame([tuple(r) for r in few], schema)
            files = store.window_files(clustered, known, window_minutes, table, NARROW_FILES)
            if files is not None:
                rest = tuple(b for b in loaded.batches if not b.clustered)
                rows = store.open(table, rest).unionByName(store.open_files(table, files))
                machines = sorted({r.strMachineName for r in few})
                return _in_days(rows, days, bounds, time).filter(F.col("strMachineName").isin(machines))
    return _in_days(store.open(table, loaded.batches), days, bounds, time)


def _recomputed(store: TelemetryStore, loaded: Manifest, affected: DataFrame, window_minutes: int) -> DataFrame | None:
    """Metrics of the affected windows from their minutes; None without any.

    Windows that hold values whose sums the minutes cannot keep are computed from
    their readings, as are all when the store's first loads kept no minutes.
    """

    def from_readings(which: DataFrame) -> DataFrame | None:
        rows = _affected_readings(store, loaded, "raw", which, window_minutes)
        return None if rows is None else recompute_windows(rows, which, window_minutes)

    if not loaded.state.get("partials"):
        return from_readings(affected)
    found = _affected_readings(store, loaded, "partials", affected, window_minutes)
    if found is None:
        return None
    merged = partials.merge_windows(found, affected, window_minutes)
    if not loaded.state.get("inexact"):
        return merged.drop("nInexact")
    exact = merged.filter("nInexact = 0").drop("nInexact")
    again = from_readings(merged.filter("nInexact > 0").select(*WINDOW_KEY))
    return exact if again is None else exact.unionByName(again)


def refresh_metrics(
    store: TelemetryStore,
    as_of: datetime,
    threshold: int = 85,
    window_minutes: int = 2,
    watermark_seconds: int = 15,
    cursor: str = MAX_CLOSED,
) -> RefreshCounts:
    """Recompute the closed windows with new readings; advance the cursors.

    Metrics, then cursors, then the manifest are written, so both appear
    together or not at all. A refresh that another one has overtaken starts
    again from what that one has written.
    """
    check_parameters(window_minutes, watermark_seconds)
    while True:
        try:
            return _refresh(store, as_of, threshold, window_minutes, watermark_seconds, cursor)
        except Conflict:
            continue


def _refresh(
    store: TelemetryStore, as_of: datetime, threshold: int, window_minutes: int, watermark_seconds: int, cursor: str
) -> RefreshCounts:
    refreshed = store.manifest(REFRESH_LOG)
    loaded = store.manifest(INGEST_LOG)
    control = store.control(refreshed)

    scan = _candidate_scan(store, loaded, refreshed, as_of, window_minutes)
    pending = window_pending(scan, control, as_of, window_minutes)
    pending = pending.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        affected = closed_windows(pending, as_of, watermark_seconds, window_minutes)
        # The same snapshot as the scan: readings loaded meanwhile wait.
        metrics = _recomputed(store, loaded, affected, window_minutes)
        state = {"as_of": as_of.isoformat(sep=" "), "loaded": loaded.snapshot}
        if metrics is None:
            low_water = _low_water(pending, control, control, loaded, as_of)
            store.commit(REFRESH_LOG, refreshed.extended(low_water=low_water, **state))
            return RefreshCounts(0, 0)

        batch_id = store.claim(REFRESH_LOG, refreshed)
        store.write("metrics", stamp_metrics(flag_alerts(metrics, threshold), as_of), batch_id)
        added, found = store.describe(
            "metrics", batch_id, F.count_distinct("strMachineName").alias("machines")
        )

        processed = cursor_updates(pending, as_of, watermark_seconds, window_minutes, cursor)
        moved = successful_machines(processed, store.written("metrics", batch_id))
        store.write("control", upsert_control(control, stamp_cursors(moved, as_of)), batch_id)
        advanced = store.written("control", batch_id)

        low_water = _low_water(pending, control, advanced, loaded, as_of)
        batches = [added] if added else []
        state |= {"control": batch_id, "low_water": low_water}
        _commit(store, REFRESH_LOG, refreshed.extended(*batches, used=batch_id, **state))
        return RefreshCounts(found["rows"], found["machines"])
    finally:
        pending.unpersist()


def _low_water(
    pending: DataFrame,
    control: DataFrame,
    advanced: DataFrame,
    loaded: Manifest,
    as_of: datetime,
) -> int:
    """No reading with a lower id can become a candidate later.

    What is left are ids past the new cursors in windows up to a day ahead,
    and, for machines that just got their first cursor, everything past it:
    their readings from before the first-load bound count from now on.
    """
    near = F.col("dtWindowStart") <= ntz(as_of + NEAR_FUTURE)
    bounds = [c for c in pending.columns if not c.endswith("PendingId")]
    left = pending_against(pending.filter(near).select(*bounds), advanced).select(
        F.col("nFirstPendingId").alias("id")
    )
    if advanced is not control:
        newcomers = advanced.join(control, "strMachineName", "left_anti")
        left = left.unionByName(
            newcomers.select((F.col("nLastProcessedSourceId") + 1).alias("id"))
        )
    lowest = left.agg(F.min("id")).first()[0]
    return loaded.max_id + 1 if lowest is None else min(lowest, loaded.max_id + 1)


# -- the same dataflow without a store ----------------------------------------


@dataclass(frozen=True)
class RefreshFrames:
    """What one refresh writes: new metric rows and new cursors."""

    updates: DataFrame
    cursors: DataFrame


def refresh_frames(
    raw: DataFrame,
    control: DataFrame | None,
    as_of: datetime,
    threshold: int = 85,
    window_minutes: int = 2,
    watermark_seconds: int = 15,
    cursor: str = MAX_CLOSED,
) -> RefreshFrames:
    """A refresh over plain frames, as one lazy plan; ``control`` may be None."""
    check_parameters(window_minutes, watermark_seconds)
    if control is None:
        control = empty(raw.sparkSession, CONTROL)
    pending = window_pending(raw, control, as_of, window_minutes)
    affected = closed_windows(pending, as_of, watermark_seconds, window_minutes)
    # Closed windows hold no later readings; the bound reaches the Parquet scan.
    ended = raw.filter(F.col("dtInsert") < ntz(as_of - timedelta(seconds=watermark_seconds)))
    metrics = flag_alerts(recompute_windows(ended, affected, window_minutes), threshold)
    processed = cursor_updates(pending, as_of, watermark_seconds, window_minutes, cursor)
    return RefreshFrames(
        stamp_metrics(metrics, as_of),
        stamp_cursors(successful_machines(processed, metrics), as_of),
    )
