"""Fleet views kept from refresh to refresh instead of being derived from every window.

Two tables are kept: the newest window of each machine, and totals per machine and
full hour of window starts. A refresh changes the hours it wrote windows of; those are
added up anew from their windows' newest versions, so whatever a recompute takes back
(an alert, records, a processing time) is gone from the view as well.
"""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.operators import fleet
from fleetmetrics.operators.merge import latest_metrics
from fleetmetrics.schemas import METRICS

HOUR_KEY = ["strMachineName", "dtHour"]
HOURS = T.StructType(
    [
        T.StructField("strMachineName", T.StringType()),
        T.StructField("dtHour", T.TimestampNTZType()),
        T.StructField("nWindows", T.LongType()),
        T.StructField("nRecords", T.LongType()),
        T.StructField("nLastSourceId", T.LongType()),
        T.StructField("dtProcessing", T.TimestampNTZType()),
    ]
)
LATEST = T.StructType([T.StructField(fleet.VIEW_COLUMNS[f.name], f.dataType) for f in METRICS.fields])
_TABLE_NAMES = {shown: name for name, shown in fleet.VIEW_COLUMNS.items()}


def with_hours(windows: DataFrame) -> DataFrame:
    """Windows that have a machine and a start, with the full hour of the start."""
    known = windows.dropna(subset=["strMachineName", "dtWindowStart"])
    return known.withColumn("dtHour", F.date_trunc("hour", "dtWindowStart").cast("timestamp_ntz"))


def hour_totals(windows: DataFrame) -> DataFrame:
    """HOURS of windows that are there in one version each."""
    grouped = with_hours(windows).groupBy(*HOUR_KEY)
    return grouped.agg(
        F.count("*").alias("nWindows"),
        F.coalesce(F.sum("nRecords"), F.lit(0)).cast("long").alias("nRecords"),
        F.max("nLastSourceId").alias("nLastSourceId"),
        F.max("dtProcessing").alias("dtProcessing"),
    )


def changed_hours(log: DataFrame, changed: DataFrame) -> DataFrame:
    """HOURS of those hours in which ``changed`` has windows, added up from the log."""
    touched = with_hours(changed).select(*HOUR_KEY).distinct()
    versions = with_hours(log).join(touched, HOUR_KEY, "left_semi")
    return hour_totals(latest_metrics(versions))


def newest_hours(log: DataFrame) -> DataFrame:
    """Newest row per machine and hour of an append log with a ``batch_id``."""
    values = [c for c in HOURS.fieldNames() if c not in HOUR_KEY]
    newest = [F.max_by(F.col(c), F.col("batch_id")).alias(c) for c in values]
    return log.groupBy(*HOUR_KEY).agg(*newest).select(*HOURS.fieldNames())


def advanced_latest(latest: DataFrame, changed: DataFrame) -> DataFrame:
    """The newest window per machine after a change; ``changed`` has a ``batch_id`` above 0.

    Windows are replaced but never removed, so what was newest and what has changed
    are all that can be newest now.
    """
    before = latest.select(*[F.col(shown).alias(name) for shown, name in _TABLE_NAMES.items()])
    versions = changed.select(*METRICS.fieldNames(), "batch_id")
    versions = versions.unionByName(before.withColumn("batch_id", F.lit(0).cast("long")))
    return fleet.latest_per_machine(fleet.metrics_view(latest_metrics(versions)))


def first_full_hour(since: datetime) -> datetime:
    hour = since.replace(minute=0, second=0, microsecond=0)
    return hour if hour == since else hour + timedelta(hours=1)


def machine_totals(*hours: DataFrame) -> DataFrame:
    """Machine, TotalRecords, Windows, LatestProcessing, from HOURS of disjoint windows."""
    rows = hours[0]
    for more in hours[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(F.col("strMachineName").alias("Machine")).agg(
        F.sum("nRecords").alias("TotalRecords"),
        F.sum("nWindows").alias("Windows"),
        F.max("dtProcessing").alias("LatestProcessing"),
    )


def machine_kpis(latest: DataFrame, totals: DataFrame) -> DataFrame:
    """As ``fleet.machine_kpis``, from the kept tables."""
    alert = F.coalesce("TemperatureAlert", F.lit(False)).alias("TemperatureAlert")
    return totals.join(latest, "Machine").select(
        "Machine", "TotalRecords", "Windows", *[f"Average{m}" for m in fleet.MEASURES], alert, "ProcessingDate"
    )


def fleet_kpis(latest: DataFrame, totals: DataFrame) -> DataFrame:
    """As ``fleet.fleet_kpis``, from the kept tables."""
    machines = totals.join(latest.select("Machine", "TemperatureAlert"), "Machine")
    return machines.agg(
        F.coalesce(F.sum("TotalRecords"), F.lit(0)).alias("TotalRecords"),
        F.coalesce(F.sum("Windows"), F.lit(0)).alias("Windows"),
        F.count("*").alias("Machines"),
        F.max("LatestProcessing").alias("LatestProcessing"),
        F.count_if("TemperatureAlert").alias("MachinesInAlert"),
    ).withColumn("HasTemperatureAlert", F.col("MachinesInAlert") > 0)
