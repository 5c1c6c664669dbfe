"""The registered queries: every operator over whole test tables."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.functions.values import rounded_int
from fleetmetrics.operators import decode, fleet, hierarchy, ingest, latency, merge, partials, windows
from fleetmetrics.plans import fixtures, jobs, views
from fleetmetrics.schemas import BUFFER
from fleetmetrics.session import scratch_folder
from fleetmetrics.sources.message_log import append_segment, log_stream
from fleetmetrics.sources.store import INGEST_LOG, TelemetryStore
from fleetmetrics.streaming import keyed, streams

Query = Callable[[SparkSession, str], DataFrame]

OVERLAPPING = 7
SELECTED_MACHINE = "Machine3"
AVAILABLE_NOW = {"availableNow": True}


def _rounded(frame: DataFrame) -> DataFrame:
    """Averages to 6 digits: their last bits depend on the order of summation."""
    averages = [c for c in frame.columns if "Average" in c]
    return frame.withColumns({c: F.round(c, 6) for c in averages})


# -- sources, decode, ingest, sinks -------------------------------------------


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_messages(fixtures.messages(spark, sf_dir))


def quarantine_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = decode.quarantine_messages(fixtures.messages(spark, sf_dir))
    return rejected.select("nId", "reject_reason", "reject_field")


def encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.encode_messages(fixtures.cadence_buffer(fixtures.events(spark, sf_dir)))


def assign_source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fixtures.events(spark, sf_dir).select("event_id", "ts", "value")
    return ingest.assign_source_ids(stored, base=1000)


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    def spoil(column: str, turn: int, value: str) -> Column:
        return F.when(F.col("nId") % 40 == turn, F.expr(value)).otherwise(F.col(column))

    buffer = fixtures.cadence_buffer(fixtures.events(spark, sf_dir))
    spoiled = buffer.withColumns(
        {
            "strMachineName": F.when(F.col("nId") % 40 == 6, F.repeat(F.lit("M"), F.lit(101)))
            .otherwise(spoil("strMachineName", 1, "cast(null as string)")),
            "fA": spoil("fA", 2, "cast(null as double)"),
            "fV": spoil("fV", 3, "cast(null as double)"),
            "nTemperature": spoil("nTemperature", 4, "3.0e9D"),
            "dtInsert": spoil("dtInsert", 5, "cast(null as timestamp_ntz)"),
        }
    )
    return decode.constraint_violations(spoiled).select("nId", "reject_field")


def ingest_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_cursor(fixtures.cadence(spark, sf_dir))


def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    buffer = fixtures.cadence_buffer(fixtures.events(spark, sf_dir))
    return ingest.incremental_scan(buffer, fixtures.half_way(fixtures.cadence(spark, sf_dir)))


def temperature_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    buffer = fixtures.cadence_buffer(fixtures.events(spark, sf_dir))
    readings = buffer.select("nId", (F.col("nTemperature") - 75).alias("nMeasured"))
    return readings.withColumn("nTemperature", rounded_int(F.col("nMeasured")))


def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.cadence(spark, sf_dir)
    loaded = raw.filter(F.col("nSourceId") <= fixtures.half_way(raw))
    return ingest.idempotent_append(loaded, raw.unionByName(raw))


def interval_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a load adds to two loads with gaps, whose ids it brings again, and twice."""
    store = TelemetryStore.create(spark, scratch_folder(spark, "intervals"))
    raw = fixtures.cadence(spark, sf_dir)
    half = fixtures.half_way(raw)
    turn = F.floor(F.col("nSourceId") / 1000) % 2
    loads = [raw.filter((F.col("nSourceId") <= half) & (turn == t)) for t in (0, 1)]
    for load in [*loads, raw.unionByName(raw)]:
        jobs.append_raw(store, store.manifest(INGEST_LOG), load, gap=100)
    newest = store.manifest(INGEST_LOG).batches[-1]
    return store.open("raw", (newest,)).select(*raw.columns)


def ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests of a growing buffer; the second finds only the newer half."""
    store = TelemetryStore.create(spark, scratch_folder(spark, "ingest"))
    buffer = fixtures.cadence_buffer(fixtures.events(spark, sf_dir))
    raw = fixtures.cadence(spark, sf_dir)
    as_of, half = fixtures.latest_reading(raw), fixtures.half_way(raw)
    jobs.ingest(store, as_of, buffer.filter(F.col("nId") <= half))
    jobs.ingest(store, as_of, buffer)
    return store.raw()


def concurrent_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers at once, whose loads share half of their rows."""
    root = scratch_folder(spark, "concurrent")
    TelemetryStore.create(spark, root)
    raw = fixtures.cadence(spark, sf_dir)
    as_of, half = fixtures.latest_reading(raw), fixtures.half_way(raw)
    buffer = fixtures.cadence_buffer(fixtures.events(spark, sf_dir))
    loads = [buffer.filter(F.col("nId") <= half + half // 2), buffer]
    with ThreadPoolExecutor(len(loads)) as writers:
        done = [writers.submit(jobs.ingest, TelemetryStore(spark, root), as_of, load) for load in loads]
        for one in done:
            one.result()
    return TelemetryStore(spark, root).raw()


def _text_buffer(spark: SparkSession, sf_dir: str) -> TelemetryStore:
    """A store after loading a buffer with dates as text and every eighth row broken."""
    store = TelemetryStore.create(spark, scratch_folder(spark, "text"))
    buffer = fixtures.cadence_buffer(fixtures.events(spark, sf_dir))
    as_of = fixtures.latest_reading(fixtures.cadence(spark, sf_dir))
    turn = F.col("nId") % 40
    date = F.date_format("dtInsert", "yyyy-MM-dd HH:mm:ss")
    long_name = F.when(turn == 5, F.repeat(F.lit("M"), F.lit(101))).otherwise(F.col("strMachineName"))
    text = buffer.withColumns(
        {
            "dtInsert": F.when(turn == 1, "2024-13-45 99:00:00").otherwise(date),
            "strMachineName": F.when(turn != 2, long_name),
            "fA": F.when(turn != 3, F.col("fA")),
            "nTemperature": F.when(turn == 4, F.lit(3.0e9)).otherwise(F.col("nTemperature")),
        }
    )
    jobs.ingest(store, as_of, text)
    return store


def ingest_text_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reached the raw table."""
    return _text_buffer(spark, sf_dir).raw()


def ingest_text_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What went to the quarantine instead, with the column at fault."""
    refused = _text_buffer(spark, sf_dir).quarantine()
    number = F.get_json_object("value", "$.nSourceId").cast("long")
    return refused.select(number.alias("nId"), "reject_field")


# -- window metrics -----------------------------------------------------------


def assign_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.native(spark, sf_dir).select("nSourceId", "strMachineName", "dtInsert")
    by_two = windows.assign_windows(raw, 2).withColumnRenamed("dtWindowStart", "dtStart2")
    by_seven = windows.assign_windows(by_two, OVERLAPPING)
    return by_seven.withColumnRenamed("dtWindowStart", "dtStart7")


def _state(spark: SparkSession, sf_dir: str):
    raw = fixtures.cadence(spark, sf_dir)
    return raw, fixtures.half_way_control(raw), fixtures.latest_reading(raw)


def candidate_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.candidate_readings(*_state(spark, sf_dir))


def candidate_readings_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month-long timeline, where the first-load bound cuts something off."""
    raw = fixtures.native(spark, sf_dir)
    control = fixtures.half_way_control(raw)
    return windows.candidate_readings(raw, control, fixtures.latest_reading(raw))


def _closed(spark: SparkSession, sf_dir: str, length: int = 2) -> DataFrame:
    raw, control, as_of = _state(spark, sf_dir)
    candidates = windows.candidate_readings(raw, control, as_of)
    assigned = windows.assign_windows(candidates, length)
    return windows.closed_window_readings(assigned, as_of, 15, length)


def closed_window_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed(spark, sf_dir)


def affected_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.affected_windows(_closed(spark, sf_dir))


def recompute_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    affected = windows.affected_windows(_closed(spark, sf_dir))
    return _rounded(windows.recompute_windows(fixtures.cadence(spark, sf_dir), affected))


def recompute_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-minute windows: the last one of an hour reaches into the next."""
    affected = windows.affected_windows(_closed(spark, sf_dir, OVERLAPPING))
    raw = fixtures.cadence(spark, sf_dir)
    return _rounded(windows.recompute_windows(raw, affected, OVERLAPPING))


def recompute_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected windows from minutes of two loads, without their readings."""
    raw = fixtures.cadence(spark, sf_dir)
    affected = windows.affected_windows(_closed(spark, sf_dir))
    first = F.col("nSourceId") <= fixtures.half_way(raw)
    minutes = partials.minute_partials(raw.filter(first)).unionByName(partials.minute_partials(raw.filter(~first)))
    return _rounded(partials.merge_windows(minutes, affected).drop("nInexact"))


def window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(windows.window_metrics(fixtures.cadence(spark, sf_dir)))


def temperature_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = windows.flag_alerts(windows.window_metrics(fixtures.cadence(spark, sf_dir)))
    return flagged.select(*windows.WINDOW_KEY, "nMaximumTemperature", "bTemperatureAlert")


def processed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.processed_sources(_closed(spark, sf_dir))


def successful_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only machines with an alert window count as written here."""
    processed = windows.processed_sources(_closed(spark, sf_dir))
    written = fixtures.finished_metrics(fixtures.cadence(spark, sf_dir))
    return windows.successful_machines(processed, written.filter("bTemperatureAlert"))


def _frames(spark: SparkSession, sf_dir: str) -> jobs.RefreshFrames:
    return jobs.refresh_frames(*_state(spark, sf_dir))


def refresh_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_frames(spark, sf_dir).updates)


def refresh_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: one refresh with no cursors yet."""
    raw = fixtures.cadence(spark, sf_dir)
    return _rounded(jobs.refresh_frames(raw, None, fixtures.latest_reading(raw)).updates)


def refresh_below_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, control, as_of = _state(spark, sf_dir)
    frames = jobs.refresh_frames(raw, control, as_of, cursor=windows.BELOW_OPEN)
    return merge.upsert_control(control, frames.cursors)


def refresh_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir)
    written = frames.updates.select(F.lit(1).alias("metric"), F.lit(0).alias("machine"))
    moved = frames.cursors.select(F.lit(0).alias("metric"), F.lit(1).alias("machine"))
    return written.unionByName(moved).agg(
        F.coalesce(F.sum("metric"), F.lit(0)).alias("nProcessedMetrics"),
        F.coalesce(F.sum("machine"), F.lit(0)).alias("nUpdatedMachines"),
    )


def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = fixtures.first_half_metrics(fixtures.cadence(spark, sf_dir))
    return _rounded(merge.merge_metrics(existing, _frames(spark, sf_dir).updates))


def upsert_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, control, _ = _state(spark, sf_dir)
    return merge.upsert_control(control, _frames(spark, sf_dir).cursors)


def late_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with a refresh after each, through the store.

    Late rows of the second load reopen windows of the first.
    """
    store = TelemetryStore.create(spark, scratch_folder(spark, "late"))
    raw = fixtures.cadence(spark, sf_dir)
    first = raw.filter(F.col("nSourceId") <= fixtures.half_way(raw))
    for part in (first, raw):
        jobs.append_raw(store, store.manifest(INGEST_LOG), part)
        jobs.refresh_metrics(store, fixtures.latest_reading(part))
    return _rounded(store.metrics())


def late_recompute_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As late_recompute, but what was loaded first lies merged along the curve."""
    store = TelemetryStore.create(spark, scratch_folder(spark, "clustered"))
    raw = fixtures.cadence(spark, sf_dir)
    half = fixtures.half_way(raw)
    first = raw.filter(F.col("nSourceId") <= half)
    for part in (first.filter(F.col("nSourceId") <= half // 2), first):
        jobs.append_raw(store, store.manifest(INGEST_LOG), part)
    store.compact(INGEST_LOG, min_batches=2, file_rows=1000)
    jobs.refresh_metrics(store, fixtures.latest_reading(first))
    jobs.append_raw(store, store.manifest(INGEST_LOG), raw)
    jobs.refresh_metrics(store, fixtures.latest_reading(raw))
    return _rounded(store.metrics())


# -- fleet views --------------------------------------------------------------


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.finished_metrics(fixtures.cadence(spark, sf_dir))


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.metrics_view(_finished(spark, sf_dir))


def metrics_last_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = fixtures.latest_reading(fixtures.cadence(spark, sf_dir))
    return _rounded(fleet.metrics_last_period(_finished(spark, sf_dir), now))


def period_view_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hour at half past midnight, read from a store after a refresh."""
    store = TelemetryStore.create(spark, scratch_folder(spark, "period"))
    raw = fixtures.native(spark, sf_dir)
    night = fixtures.latest_reading(raw).replace(hour=0, minute=30, second=0, microsecond=0)
    jobs.append_raw(store, store.manifest(INGEST_LOG), raw)
    jobs.refresh_metrics(store, night)
    return _rounded(store.period_view(night, 60))


def period_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.native(spark, sf_dir)
    return fleet.period_rollup(fixtures.finished_metrics(raw), fixtures.latest_reading(raw))


def period_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periods from stored nodes of 1 to 2,048 minutes, in place of all windows."""
    raw = fixtures.native(spark, sf_dir)
    folder = scratch_folder(spark, "nodes")
    hierarchy.write_nodes(hierarchy.window_nodes(fixtures.finished_metrics(raw)), folder)
    return hierarchy.period_totals(spark.read.parquet(folder), fixtures.latest_reading(raw))


def machine_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.machine_list(_view(spark, sf_dir))


def machine_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fleet.machine_series(_view(spark, sf_dir), SELECTED_MACHINE))


def selected_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown name falls back to all machines."""
    chosen = fleet.select_machine(_view(spark, sf_dir), "Machine99")
    return chosen.groupBy("Machine").agg(F.count("*").alias("Windows"))


def latest_per_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fleet.latest_per_machine(_view(spark, sf_dir)))


def machines_in_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold lowered so that some of the latest windows are in alert."""
    raw = fixtures.cadence(spark, sf_dir)
    view = fleet.metrics_view(fixtures.finished_metrics(raw, threshold=80))
    return fleet.machines_in_alert(view)


def fleet_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_kpis(_view(spark, sf_dir))


def machine_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fleet.machine_kpis(_view(spark, sf_dir)))


def _kept_views(spark: SparkSession, sf_dir: str) -> views.PeriodViews:
    """The last hour, kept after each of two refreshes, of which the second reopens windows."""
    store = TelemetryStore.create(spark, scratch_folder(spark, "views"))
    raw = fixtures.cadence(spark, sf_dir)
    for part in (raw.filter(F.col("nSourceId") <= fixtures.half_way(raw)), raw):
        jobs.append_raw(store, store.manifest(INGEST_LOG), part)
        now = fixtures.latest_reading(part)
        jobs.refresh_metrics(store, now)
        views.keep_views(store)
    return views.period_views(store, now, 60)


def kept_machine_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_kept_views(spark, sf_dir).machine_kpis())


def kept_fleet_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_views(spark, sf_dir).fleet_kpis()


def metric_band_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fleet.metric_band_series(_view(spark, sf_dir)))


def fleet_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.cadence(spark, sf_dir)
    view = fleet.metrics_view(fixtures.finished_metrics(raw, threshold=80))
    return _rounded(fleet.fleet_series(view, threshold=80))


def kpi_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.machine_display(fleet.machine_kpis(_view(spark, sf_dir)))


def fleet_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_display(fleet.fleet_kpis(_view(spark, sf_dir)))


def fleet_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.cadence(spark, sf_dir)
    view = fleet.metrics_view(fixtures.finished_metrics(raw, threshold=80))
    whole = fleet.fleet_status(fleet.fleet_kpis(view))
    return whole.unionByName(fleet.machine_status(fleet.machine_kpis(view)))


def ingestion_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(latency.ingestion_latency(fixtures.cadence(spark, sf_dir)))


def processing_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(latency.processing_delay(_finished(spark, sf_dir)))


# -- streams ------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fixtures.events(spark, sf_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def _finish(query) -> None:
    query.awaitTermination()


def stream_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "stream-readings")
    store = TelemetryStore.create(spark, f"{folder}/store")
    messages = fixtures.message_stream(_event_stream(spark, sf_dir))
    _finish(
        streams.stream_readings(messages, store, f"{folder}/checkpoint", trigger=AVAILABLE_NOW)
    )
    return store.buffer()


def stream_message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages through a log of several partitions; the stream ends between its two
    segments and goes on from its offsets. Ids are left out: a log orders its partitions only."""
    folder = scratch_folder(spark, "stream-log")
    store = TelemetryStore.create(spark, f"{folder}/store")
    messages = fixtures.messages(spark, sf_dir)
    first = F.col("nId") <= messages.count() // 2
    for number, part in enumerate((first, ~first)):
        append_segment(messages.filter(part), f"{folder}/log", number)
        arrived = log_stream(spark, f"{folder}/log")
        _finish(streams.stream_readings(arrived, store, f"{folder}/checkpoint", trigger=AVAILABLE_NOW))
    return store.buffer().select(*BUFFER.fieldNames()[1:])


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "stream-ingest")
    store = TelemetryStore.create(spark, f"{folder}/store")
    as_of = fixtures.latest_reading(fixtures.cadence(spark, sf_dir))
    messages = fixtures.message_stream(_event_stream(spark, sf_dir))
    _finish(
        streams.stream_ingest(
            messages, store, f"{folder}/checkpoint", lambda: as_of, trigger=AVAILABLE_NOW
        )
    )
    return store.raw()


def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events stream serves as the clock: one refresh per micro-batch."""
    folder = scratch_folder(spark, "stream-refresh")
    store = TelemetryStore.create(spark, f"{folder}/store")
    raw = fixtures.cadence(spark, sf_dir)
    as_of = fixtures.latest_reading(raw)
    jobs.append_raw(store, store.manifest(INGEST_LOG), raw)
    ticks = _event_stream(spark, sf_dir)
    _finish(
        streams.stream_refresh(
            ticks, store, f"{folder}/checkpoint", lambda: as_of, trigger=AVAILABLE_NOW
        )
    )
    return _rounded(store.metrics())


def stream_refresh_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from keyed state over the stream of readings."""
    folder = scratch_folder(spark, "stream-keyed")
    store = TelemetryStore.create(spark, f"{folder}/store")
    as_of = fixtures.latest_reading(fixtures.cadence(spark, sf_dir))
    readings = fixtures.as_raw(fixtures.cadence_buffer(_event_stream(spark, sf_dir)))
    _finish(
        keyed.stream_keyed_refresh(
            readings, store, f"{folder}/checkpoint", lambda _: as_of, trigger=AVAILABLE_NOW
        )
    )
    return _rounded(store.metrics())


def stream_window_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches in arrival order; late rows of the second are dropped."""
    folder = scratch_folder(spark, "stream-native")
    raw = fixtures.cadence(spark, sf_dir)
    first = F.col("nSourceId") <= fixtures.half_way(raw)
    for part in (first, ~first):
        raw.filter(part).write.mode("append").parquet(f"{folder}/arrived")
        readings = spark.readStream.schema(raw.schema).parquet(f"{folder}/arrived")
        _finish(
            streams.stream_native_windows(
                readings, f"{folder}/windows", f"{folder}/checkpoint", trigger=AVAILABLE_NOW
            )
        )
    schema = streams.native_windows(raw).schema
    return _rounded(spark.read.schema(schema).parquet(f"{folder}/windows"))


CATALOGUE: tuple[Query, ...] = (
    decode_messages,
    quarantine_messages,
    encode_messages,
    assign_source_ids,
    constraint_violations,
    ingest_cursor,
    incremental_scan,
    temperature_rounding,
    idempotent_append,
    interval_append,
    ingest_job,
    concurrent_ingest,
    ingest_text_buffer,
    ingest_text_refused,
    assign_windows,
    candidate_readings,
    candidate_readings_native,
    closed_window_readings,
    affected_windows,
    recompute_windows,
    recompute_overlapping,
    recompute_partials,
    window_metrics,
    temperature_alerts,
    processed_sources,
    successful_machines,
    refresh_metrics,
    refresh_first_load,
    refresh_below_open,
    refresh_summary,
    upsert_metrics,
    upsert_control,
    late_recompute,
    late_recompute_clustered,
    metrics_last_period,
    period_view_store,
    period_rollup,
    period_hierarchy,
    machine_list,
    machine_series,
    selected_machine,
    latest_per_machine,
    machines_in_alert,
    fleet_kpis,
    machine_kpis,
    kept_machine_kpis,
    kept_fleet_kpis,
    metric_band_series,
    fleet_series,
    kpi_display,
    fleet_display,
    fleet_status,
    ingestion_latency,
    processing_delay,
    stream_readings,
    stream_message_log,
    stream_ingest,
    stream_refresh,
    stream_refresh_keyed,
    stream_window_native,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in CATALOGUE}
