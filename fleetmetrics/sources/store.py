"""Parquet tables with all-or-nothing batches, written with DataFrame writers only.

A table is a folder of batches, ``<table>/batch_id=N/...``. A batch is visible
once it is listed in its log's manifest, so a job that dies half-way leaves
nothing behind but a folder that ``expire`` deletes. A batch id is claimed by one
writer for good, and a manifest has a number that only one writer can commit:
of two writers that started from one manifest, the second gets a ``Conflict``
and has to look at what has changed.

The manifest holds one row per live batch with its id and date range. Readers
open just the batches they need instead of listing the whole table. Merged
batches of readings are clustered by machine and time, and a zone map tells
which of their files hold a machine's stretch of time.
"""

import json
from dataclasses import asdict, dataclass, field, replace
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.functions import clustering
from fleetmetrics.operators.fleet import last_period
from fleetmetrics.operators.intervals import GAP, RUNS, id_runs, merged_runs
from fleetmetrics.operators.merge import latest_metrics
from fleetmetrics.operators.partials import PARTIALS, minute_partials, summed_partials
from fleetmetrics.operators.views import HOURS, LATEST, newest_hours
from fleetmetrics.schemas import BUFFER, CONTROL, METRICS, QUARANTINE, RAW
from fleetmetrics.session import empty
from fleetmetrics.sources.commits import Conflict, NumberedFiles

READINGS_LOG = "readings"
INGEST_LOG = "ingest"
REFRESH_LOG = "refresh"
VIEWS_LOG = "views"


def _with(schema: T.StructType, *extra: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(n, t) for n, t in extra])


_BATCH = ("batch_id", T.LongType())
TABLES = {
    "staged": _with(
        T.StructType(BUFFER.fields[1:] + QUARANTINE.fields),
        _BATCH,
        ("rejected", T.BooleanType()),
    ),
    "buffer": _with(BUFFER, _BATCH),
    "raw": _with(RAW, _BATCH, ("event_date", T.DateType())),
    "partials": _with(PARTIALS, _BATCH, ("event_date", T.DateType())),
    "runs": _with(RUNS, _BATCH),
    "metrics": _with(METRICS, _BATCH, ("window_date", T.DateType())),
    "control": _with(CONTROL, _BATCH),
    "rejected": _with(QUARANTINE, _BATCH),
    "hours": _with(HOURS, _BATCH, ("hour_date", T.DateType())),
    "latest": _with(LATEST, _BATCH),
}
ID_COLUMN = {"buffer": "nId", "raw": "nSourceId", "partials": "nLastSourceId", "metrics": "nLastSourceId", "hours": "nLastSourceId"}
DATE_COLUMN = {"raw": "event_date", "partials": "event_date", "metrics": "window_date", "hours": "hour_date"}
TIME_COLUMN = {"raw": "dtInsert", "partials": "dtMinute", "metrics": "dtWindowStart", "hours": "dtHour"}
LOG_TABLE = {READINGS_LOG: "buffer", INGEST_LOG: "raw", REFRESH_LOG: "metrics", VIEWS_LOG: "hours"}
# Of these the newest batch wins; the frame of newest rows.
NEWEST = {"metrics": latest_metrics, "hours": newest_hours}
# A small table that each batch of the log replaces as a whole.
WHOLE_TABLE = {REFRESH_LOG: "control", VIEWS_LOG: "latest"}
# Written beside a log's table under the same batch ids; every committed id is live.
SIDE_TABLE = {READINGS_LOG: "staged", INGEST_LOG: "rejected"}

# Readings per minute of a machine, added up under the batch ids of the readings.
PARTIAL_OF = {"raw": "partials"}
ZONES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("low_bucket", T.IntegerType()),
        T.StructField("high_bucket", T.IntegerType()),
        T.StructField("low", T.TimestampNTZType()),
        T.StructField("high", T.TimestampNTZType()),
    ]
)
#: Rows of a file of a clustered batch.
FILE_ROWS = 4_000_000


@dataclass(frozen=True)
class Batch:
    """A live batch. ``origin`` is the manifest that brought its newest load; a clustered one has zones.

    ``runs`` says that the runs of its ids are stored.
    """

    batch_id: int
    origin: int
    rows: int
    min_id: int
    max_id: int
    first_date: str | None = None
    last_date: str | None = None
    clustered: bool = False
    runs: bool = False


@dataclass(frozen=True)
class Manifest:
    """Snapshot of a log: its number, live batches in order, and job state."""

    snapshot: int = 0
    batches: tuple[Batch, ...] = ()
    state: dict = field(default_factory=dict)

    @property
    def ids(self) -> list[list[int]]:
        """All committed batch ids, as ranges [first, last]."""
        return self.state.get("ids", [])

    @property
    def next_id(self) -> int:
        """The lowest batch id that may be free."""
        return max(self.snapshot, self.ids[-1][1] if self.ids else 0) + 1

    @property
    def max_id(self) -> int:
        return max((b.max_id for b in self.batches), default=0)

    def extended(
        self, *added: Batch, used: int | None = None, dropped: tuple[Batch, ...] = (), **state
    ) -> "Manifest":
        """The next manifest; ``used`` is the batch id that is committed with it."""
        kept = tuple(b for b in self.batches if b not in dropped)
        if not dropped:
            # Ids are claimed early; only the commit tells which load is newer.
            added = tuple(replace(b, origin=self.snapshot + 1) for b in added)
        ids = self.ids if used is None else _with_id(self.ids, used)
        return Manifest(self.snapshot + 1, kept + added, {**self.state, "ids": ids, **state})


def _with_id(ids: list[list[int]], new: int) -> list[list[int]]:
    """The ranges with one more number."""
    merged: list[list[int]] = []
    for first, last in sorted([*ids, [new, new]]):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(last, merged[-1][1])
        else:
            merged.append([first, last])
    return merged


class TelemetryStore:
    """The tables below ``root``; ``create`` makes them when they are missing."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> "TelemetryStore":
        """An empty store, or an existing one as it is."""
        store = cls(spark, root)
        for log in LOG_TABLE:
            if store._commits(log).newest() is None:
                try:
                    store.commit(log, Manifest())
                except Conflict:  # created by another at the same time
                    pass
        return store

    def path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    # -- manifests -----------------------------------------------------------

    def _commits(self, log: str) -> NumberedFiles:
        return NumberedFiles(self.spark, f"{self.root}/commits/{log}", "manifest")

    def manifest(self, log: str) -> Manifest:
        newest = self._commits(log).newest()
        if newest is None:
            raise RuntimeError(f"no manifest for {log!r} below {self.root}")
        body = json.loads(newest[1])
        batches = tuple(Batch(**b) for b in body["batches"])
        return Manifest(newest[0], batches, body["state"])

    def commit(self, log: str, manifest: Manifest) -> None:
        """Make this the log's newest manifest; Conflict if there is one of its number."""
        body = {"batches": [asdict(b) for b in manifest.batches], "state": manifest.state}
        self._commits(log).put_next(manifest.snapshot, json.dumps(body))

    def claim(self, log: str, manifest: Manifest) -> int:
        """A batch id that no other writer has or will get."""
        claims = NumberedFiles(self.spark, f"{self.root}/claims/{log}", "batch")
        batch_id = manifest.next_id
        while True:
            try:
                claims.put(batch_id, "")
                return batch_id
            except Conflict:
                batch_id += 1

    # -- reading -------------------------------------------------------------

    def open(self, table: str, batches: tuple[Batch, ...] | list[int]) -> DataFrame:
        """The given batches as one frame with ``batch_id`` and the date column."""
        ids = [b.batch_id if isinstance(b, Batch) else b for b in batches]
        if not ids:
            return empty(self.spark, TABLES[table])
        reader = self.spark.read.schema(TABLES[table])
        return reader.option("basePath", f"{self.root}/{table}").parquet(
            *[self.path(table, i) for i in ids]
        )

    def buffer(self) -> DataFrame:
        batches = self.manifest(READINGS_LOG).batches
        return self.open("buffer", batches).select(*BUFFER.fieldNames())

    def quarantine(self) -> DataFrame:
        """Messages and loaded rows that were rejected, of committed batches."""
        found = empty(self.spark, QUARANTINE)
        for log, table in SIDE_TABLE.items():
            manifest = self.manifest(log)
            if not manifest.state.get(table):
                continue
            side = self.spark.read.schema(TABLES[table]).parquet(f"{self.root}/{table}")
            committed = [F.col("batch_id").between(*ids) for ids in manifest.ids]
            live = side.filter(reduce(or_, committed, F.lit(False)))
            if table == "staged":
                live = live.filter("rejected")
            found = found.unionByName(live.select(*QUARANTINE.fieldNames()))
        return found

    def raw(self) -> DataFrame:
        batches = self.manifest(INGEST_LOG).batches
        return self.open("raw", batches).select(*RAW.fieldNames())

    def metrics(self, since: date | None = None) -> DataFrame:
        """Newest version of every window, optionally from a start date on."""
        batches = self.manifest(REFRESH_LOG).batches
        if since is not None:
            batches = tuple(b for b in batches if b.last_date >= since.isoformat())
        log = self.open("metrics", batches)
        if since is not None:
            log = log.filter(F.col("window_date") >= F.lit(since))
        return latest_metrics(log)

    def period_view(self, local_now: datetime, period_minutes: int) -> DataFrame:
        """The fleet view of the windows that start within the period before now."""
        since = (local_now - timedelta(minutes=int(period_minutes))).date()
        return last_period(self.metrics(since), local_now, period_minutes)

    def control(self, manifest: Manifest | None = None) -> DataFrame:
        """Each refresh writes the whole control table: one row per machine."""
        state = (manifest or self.manifest(REFRESH_LOG)).state
        ids = [state["control"]] if "control" in state else []
        return self.open("control", ids).select(*CONTROL.fieldNames())

    def window_files(
        self, batches: tuple[Batch, ...], affected: DataFrame, window_minutes: int, table: str, most: int
    ) -> list[str] | None:
        """The files of clustered batches that may hold readings of the affected windows.

        ``affected`` holds few rows (machine, dtWindowStart). None for more files
        than ``most``.
        """
        folder = f"{self.root}/zones_{table}"
        zones = self.spark.read.schema(_with(ZONES, _BATCH)).option("basePath", folder)
        zones = zones.parquet(*[f"{folder}/batch_id={b.batch_id}" for b in batches])
        length = F.make_dt_interval(mins=F.lit(window_minutes))
        wanted = affected.select(
            clustering.bucket(F.col("strMachineName")).alias("bucket"),
            F.col("dtWindowStart").alias("start"),
            (F.col("dtWindowStart") + length).alias("end"),
        )
        last = F.to_date(F.col("end") - F.expr("INTERVAL '0.000001' SECOND"))
        wanted = wanted.withColumn("day", F.explode(F.sequence(F.to_date("start"), last)))
        inside = (F.col("bucket") >= F.col("low_bucket")) & (F.col("bucket") <= F.col("high_bucket"))
        inside = inside & (F.col("high") >= F.col("start")) & (F.col("low") < F.col("end"))
        met = zones.join(F.broadcast(wanted), "day").filter(inside).select("batch_id", "day", "file").distinct()
        found = met.limit(most + 1).collect()
        if len(found) > most:
            return None
        day = DATE_COLUMN[table]
        return [f"{self.path(table, r.batch_id)}/{day}={r.day}/{r.file}" for r in found]

    def open_files(self, table: str, files: list[str]) -> DataFrame:
        if not files:
            return empty(self.spark, TABLES[table])
        reader = self.spark.read.schema(TABLES[table])
        return reader.option("basePath", f"{self.root}/{table}").parquet(*files)

    # -- writing -------------------------------------------------------------

    def write(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """Write one batch, replacing what an earlier attempt may have left.

        Dated tables are range-partitioned by time, so a day's files hold
        narrow time ranges that a scan can skip by their statistics, and a hot
        day is split over many tasks.
        """
        self._check(table, rows)
        target = self.path(table, batch_id)
        if table in DATE_COLUMN:
            time, day = TIME_COLUMN[table], DATE_COLUMN[table]
            dated = rows.withColumn(day, F.to_date(time))
            clustered = dated.repartitionByRange(time, ID_COLUMN[table])
            clustered.write.mode("overwrite").partitionBy(day).parquet(target)
        else:
            rows.write.mode("overwrite").parquet(target)

    def write_partials(self, batch_id: int) -> None:
        """Add up the written readings of a batch, per minute of each machine."""
        readings = self.written("raw", batch_id).select(*RAW.fieldNames())
        self.write("partials", minute_partials(readings), batch_id)

    def write_runs(self, batch_id: int, gap: int = GAP) -> None:
        """The runs of ids of a written batch of readings."""
        self.write("runs", id_runs(self.written("raw", batch_id), gap), batch_id)

    def write_clustered(self, table: str, rows: DataFrame, batch_id: int, files: int) -> None:
        """Write one batch in about ``files`` files along a curve through machine and time
        of each day, and its zone map."""
        self._check(table, rows)
        time, day = TIME_COLUMN[table], DATE_COLUMN[table]
        dated = rows.withColumns({day: F.to_date(time), "__curve": clustering.curve(F.col("strMachineName"), F.col(time))})
        dealt = dated.repartitionByRange(max(files, 1), day, "__curve", ID_COLUMN[table])
        target = self.path(table, batch_id)
        dealt.sortWithinPartitions(day, "__curve").drop("__curve").write.mode("overwrite").partitionBy(day).parquet(target)
        bucket = clustering.bucket(F.col("strMachineName"))
        zones = (
            self.written(table, batch_id)
            .groupBy(F.col("_metadata.file_name").alias("file"), F.col(day).alias("day"))
            .agg(
                F.min(bucket).alias("low_bucket"),
                F.max(bucket).alias("high_bucket"),
                F.min(time).alias("low"),
                F.max(time).alias("high"),
            )
        )
        zones.select(*ZONES.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/zones_{table}/batch_id={batch_id}")

    def _check(self, table: str, rows: DataFrame) -> None:
        """Refuse rows that later reads of the table could not take."""
        own = ("batch_id", DATE_COLUMN.get(table))
        wanted = {f.name: f.dataType for f in TABLES[table].fields if f.name not in own}
        given = {f.name: f.dataType for f in rows.schema.fields}
        if given != wanted:
            wrong = sorted(n for n in {**wanted, **given} if given.get(n) != wanted.get(n))
            raise TypeError(f"{table}: wrong, missing or unknown columns {', '.join(wrong)}")

    def written(self, table: str, batch_id: int) -> DataFrame:
        return self.open(table, [batch_id])

    def describe(self, table: str, batch_id: int, *extra: Column) -> tuple[Batch | None, dict]:
        """Count and ranges of a written batch, read back from its files.

        Counting what is in the files is exact even after lost executors or
        repeated tasks. No batch entry for an empty one.
        """
        source, day = F.col(ID_COLUMN[table]), DATE_COLUMN.get(table)
        dates = [F.min(day).alias("first_date"), F.max(day).alias("last_date")] if day else []
        found = (
            self.written(table, batch_id)
            .agg(
                F.count("*").alias("rows"),
                F.min(source).alias("min_id"),
                F.max(source).alias("max_id"),
                *dates,
                *extra,
            )
            .first()
            .asDict()
        )
        if not found["rows"]:
            return None, found
        ranges = {k: found[k].isoformat() for k in ("first_date", "last_date") if k in found}
        numbers = {k: found[k] for k in ("rows", "min_id", "max_id")}
        return Batch(batch_id=batch_id, origin=batch_id, **numbers, **ranges), found

    # -- upkeep --------------------------------------------------------------

    def compact(
        self,
        log: str,
        max_rows: int = 50_000_000,
        min_batches: int = 32,
        manifest: Manifest | None = None,
        file_rows: int = FILE_ROWS,
    ) -> bool:
        """Merge a run of at least ``min_batches`` adjacent small batches into one.

        Large batches are left alone, so history is not rewritten each time. Of
        metrics and views only the newest run is merged: there the newest batch
        wins. Merged readings are clustered, with about ``file_rows`` in a file.
        When another writer has replaced part of the run meanwhile, nothing is
        changed. The log's own jobs call this after each commit with the
        manifest they wrote; without a run it costs nothing. Replaced folders stay on
        disk for readers that opened them before, until ``expire``.
        """
        manifest = manifest or self.manifest(log)
        table = LOG_TABLE[log]
        runs: list[list[Batch]] = [[]]
        for batch in manifest.batches:
            if batch.rows >= max_rows:
                runs.append([])
            else:
                runs[-1].append(batch)
        if table in NEWEST:
            runs = runs[-1:]
        run = next((r for r in runs if len(r) >= min_batches), None)
        if run is None:
            return False
        batch_id = self.claim(log, manifest)
        rows = self.open(table, tuple(run)).drop("batch_id", DATE_COLUMN.get(table, ""))
        if table in NEWEST:
            rows = NEWEST[table](self.open(table, tuple(run)))
        clustered = table in PARTIAL_OF
        if clustered:
            self.write_clustered(table, rows, batch_id, -(-sum(b.rows for b in run) // file_rows))
            if manifest.state.get("partials"):
                added = summed_partials(self.open("partials", tuple(run)))
                parts = self.open("partials", tuple(run)).count()
                self.write_clustered("partials", added, batch_id, -(-parts // file_rows))
        else:
            self.write(table, rows, batch_id)
        known = all(b.runs for b in run)
        if known:
            self.write("runs", merged_runs(self.open("runs", tuple(run)).drop("batch_id")), batch_id)
        merged, _ = self.describe(table, batch_id)
        merged = replace(merged, origin=max(b.origin for b in run), clustered=clustered, runs=known)
        side = SIDE_TABLE.get(log)
        if side and manifest.state.get(side):
            # An attempt that died under this id must not become live.
            nothing = empty(self.spark, TABLES[side]).drop("batch_id").write.mode("overwrite")
            nothing = nothing.partitionBy("rejected") if side == "staged" else nothing
            nothing.parquet(self.path(side, batch_id))
        while True:
            try:
                self.commit(log, manifest.extended(merged, used=batch_id, dropped=tuple(run)))
                return True
            except Conflict:
                manifest = self.manifest(log)
                # Where the newest wins, the merged batch would have to come before newer ones.
                if not set(run) <= set(manifest.batches) or table in NEWEST:
                    return False

    def expire(self, log: str, older_than: timedelta) -> list[str]:
        """Delete folders that no manifest names, once they are older than this.

        These are batches replaced by compaction, control tables and newest windows before the
        newest, and the second copy of accepted readings that numbering needs.
        The age has to exceed the longest run of a reader. Call it from the
        log's writer. Returns what was deleted.
        """
        manifest = self.manifest(log)
        gone = []
        live = {b.batch_id for b in manifest.batches}
        table = LOG_TABLE[log]
        beside = PARTIAL_OF.get(table)
        for folders in (table, *([beside, "runs", f"zones_{table}", f"zones_{beside}"] if beside else [])):
            for folder, batch_id, age in self._folders(folders):
                if batch_id < manifest.next_id and batch_id not in live:
                    gone.append((folder, age))
        if log in WHOLE_TABLE:
            whole = WHOLE_TABLE[log]
            newest = manifest.state.get(whole, 0)
            gone += [(f, age) for f, i, age in self._folders(whole) if i < newest]
        if log == READINGS_LOG:
            gone += [
                (f"{f}/rejected=false", age)
                for f, i, age in self._folders("staged", "rejected=false")
                if i < manifest.next_id
            ]
        files = self._files()
        old = [folder for folder, age in gone if age >= older_than]
        for folder in old:
            files.delete(self._hadoop_path(folder), True)
        return old

    def _hadoop_path(self, folder: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(folder)

    def _files(self):
        """The file system of the root, as Spark itself uses it."""
        settings = self.spark._jsc.hadoopConfiguration()
        return self._hadoop_path(self.root).getFileSystem(settings)

    def _folders(self, table: str, inner: str = "") -> list[tuple[str, int, timedelta]]:
        """Batch folders of a table (that hold ``inner``) with id and age."""
        files, root = self._files(), self._hadoop_path(f"{self.root}/{table}")
        if not files.exists(root):
            return []
        now = self.spark._jvm.System.currentTimeMillis()
        found = []
        for status in files.listStatus(root):
            name = status.getPath().getName()
            folder = f"{self.root}/{table}/{name}"
            if name.startswith("batch_id=") and (
                not inner or files.exists(self._hadoop_path(f"{folder}/{inner}"))
            ):
                age = timedelta(milliseconds=now - status.getModificationTime())
                found.append((folder, int(name.removeprefix("batch_id=")), age))
        return found
