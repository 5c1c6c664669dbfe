"""Serving views over the metrics: periods, latest state, KPIs, series, status."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmetrics.functions.clock import ntz
from fleetmetrics.functions.values import fixed

# Names, menu entries and texts that users of the views rely on.
ALL_MACHINES = "__all__"
ALL_MACHINES_LABEL = "All machines"
PERIODS = {60: "Last hour", 360: "Last 6 hours", 720: "Last 12 hours", 1440: "Last 24 hours"}
DEFAULT_PERIOD = 60
DEFAULT_THRESHOLD = 85
SERIES_COLORS = 10
ALERT_MARK = "🚨 "
FLEET_ALERT = "🚨 Check highlighted machines"
FLEET_IN_RANGE = "All machines within the acceptable range"
MACHINE_ALERT = "🚨 Temperature alert active"
MACHINE_IN_RANGE = "Temperature within the acceptable range"
NO_METRICS = "No metrics found for the selected time range."
NOT_INFORMED = "Not informed"
NO_VALUE = "--"

VIEW_COLUMNS = {
    "strMachineName": "Machine",
    "dtWindowStart": "WindowStart",
    "dtWindowEnd": "WindowEnd",
    "nFirstSourceId": "FirstSourceId",
    "nLastSourceId": "LastSourceId",
    "nRecords": "Records",
    "fAverageCurrent": "AverageCurrent",
    "fMinimumCurrent": "MinimumCurrent",
    "fMaximumCurrent": "MaximumCurrent",
    "fAverageVoltage": "AverageVoltage",
    "fMinimumVoltage": "MinimumVoltage",
    "fMaximumVoltage": "MaximumVoltage",
    "fAverageTemperature": "AverageTemperature",
    "nMinimumTemperature": "MinimumTemperature",
    "nMaximumTemperature": "MaximumTemperature",
    "bTemperatureAlert": "TemperatureAlert",
    "dtProcessing": "ProcessingDate",
}
MEASURES = ("Current", "Voltage", "Temperature")


def clean_view(view: DataFrame) -> DataFrame:
    """Timestamps that do not parse become null; rows without key are dropped."""
    stamps = ("WindowStart", "WindowEnd", "ProcessingDate")
    coerced = view.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in stamps})
    return coerced.dropna(subset=["Machine", "WindowStart"])


def metrics_view(metrics: DataFrame) -> DataFrame:
    """The metrics table under its display names."""
    return clean_view(metrics.select(*[F.col(c).alias(a) for c, a in VIEW_COLUMNS.items()]))


def last_period(
    metrics: DataFrame, local_now: datetime, period_minutes: int | None = DEFAULT_PERIOD
) -> DataFrame:
    """Windows that start within the period; there is no upper bound."""
    since = local_now - timedelta(minutes=int(period_minutes or DEFAULT_PERIOD))
    return metrics_view(metrics.filter(F.col("dtWindowStart") >= ntz(since)))


def metrics_last_period(
    metrics: DataFrame, local_now: datetime, period_minutes: int | None = DEFAULT_PERIOD
) -> DataFrame:
    """``last_period`` in (machine, start) order, for reading out."""
    return last_period(metrics, local_now, period_minutes).orderBy("Machine", "WindowStart")


def period_rollup(metrics: DataFrame, local_now: datetime) -> DataFrame:
    """Windows and records of every menu period, from one pass."""
    longest = last_period(metrics, local_now, max(PERIODS))

    def within(period: int) -> Column:
        return F.col("WindowStart") >= ntz(local_now - timedelta(minutes=period))

    totals = longest.agg(
        *[F.count_if(within(p)).alias(f"windows_{p}") for p in PERIODS],
        *[F.sum(F.when(within(p), F.col("Records"))).alias(f"records_{p}") for p in PERIODS],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(p).alias("PeriodMinutes"),
                F.lit(label).alias("Label"),
                F.col(f"windows_{p}").alias("Windows"),
                F.coalesce(F.col(f"records_{p}"), F.lit(0)).alias("Records"),
            )
            for p, label in PERIODS.items()
        ]
    )
    return totals.select(F.inline(rows))


def machine_list(view: DataFrame) -> DataFrame:
    """Menu entries: all machines first, then the machines by name."""
    spark = view.sparkSession
    everything = spark.range(1).select(
        F.lit(0).alias("Rank"),
        F.lit(ALL_MACHINES_LABEL).alias("Label"),
        F.lit(ALL_MACHINES).alias("Value"),
    )
    machines = view.select("Machine").dropna().distinct()
    named = machines.select(
        F.lit(1).alias("Rank"), F.col("Machine").alias("Label"), F.col("Machine").alias("Value")
    )
    return everything.unionByName(named).orderBy("Rank", "Value")


def machine_series(view: DataFrame, machine: str) -> DataFrame:
    return view.filter(F.col("Machine") == machine).orderBy("WindowStart")


def resolve_selection(view: DataFrame, selected: str | None) -> str:
    """The selected machine when the view has it, otherwise all machines."""
    if selected is None or selected == ALL_MACHINES:
        return ALL_MACHINES
    found = not view.filter(F.col("Machine") == selected).select(F.lit(1)).isEmpty()
    return selected if found else ALL_MACHINES


def select_machine(view: DataFrame, selected: str | None) -> DataFrame:
    resolved = resolve_selection(view, selected)
    return view if resolved == ALL_MACHINES else machine_series(view, resolved)


def _moment(column: str) -> Column:
    """Whole seconds of a zone-free timestamp."""
    clock = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
    return F.datediff(column, F.lit("1970-01-01")).cast("long") * 86400 + clock


def _newest(*columns: str) -> list[Column]:
    """Values of the last window; of two with one start, of the later end.

    Start and length make one number, and there is one ``max_by`` per column:
    values of fixed width keep this a hash aggregation. Windows start at whole
    seconds and are shorter than 34 years.
    """
    length = F.coalesce(_moment("WindowEnd") - _moment("WindowStart"), F.lit(0))
    order = F.shiftleft(_moment("WindowStart"), 30) + length
    return [F.max_by(c, order).alias(c) for c in columns]


def latest_per_machine(view: DataFrame) -> DataFrame:
    columns = [c for c in view.columns if c != "Machine"]
    return view.groupBy("Machine").agg(*_newest(*columns)).select(*view.columns)


def _alerts(view: DataFrame) -> DataFrame:
    """One row per machine: whether its latest window is in alert; unknown is not."""
    newest = view.groupBy("Machine").agg(*_newest("TemperatureAlert"))
    return newest.select(
        "Machine", F.coalesce("TemperatureAlert", F.lit(False)).alias("TemperatureAlert")
    )


def machines_in_alert(view: DataFrame) -> DataFrame:
    """Machines whose latest window is in alert; an unknown flag is none."""
    return _alerts(view).filter("TemperatureAlert").select("Machine")


def machine_kpis(view: DataFrame) -> DataFrame:
    """Totals and latest values of every machine."""
    latest = ("AverageCurrent", "AverageVoltage", "AverageTemperature")
    grouped = view.groupBy("Machine").agg(
        F.coalesce(F.sum("Records"), F.lit(0)).alias("TotalRecords"),
        F.count("*").alias("Windows"),
        *_newest(*latest, "TemperatureAlert", "ProcessingDate"),
    )
    alert = F.coalesce("TemperatureAlert", F.lit(False))
    return grouped.withColumn("TemperatureAlert", alert).select(
        "Machine", "TotalRecords", "Windows", *latest, "TemperatureAlert", "ProcessingDate"
    )


def fleet_kpis(view: DataFrame) -> DataFrame:
    """One row for the fleet; zeros for an empty period.

    Rolled up from one row per machine, so the view is read once and no count
    of distinct machines is needed.
    """
    machines = view.groupBy("Machine").agg(
        F.sum("Records").alias("records"),
        F.count("*").alias("windows"),
        F.max("ProcessingDate").alias("processed"),
        *_newest("TemperatureAlert"),
    )
    alert = F.coalesce("TemperatureAlert", F.lit(False))
    return machines.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("TotalRecords"),
        F.coalesce(F.sum("windows"), F.lit(0)).alias("Windows"),
        F.count("*").alias("Machines"),
        F.max("processed").alias("LatestProcessing"),
        F.count_if(alert).alias("MachinesInAlert"),
    ).withColumn("HasTemperatureAlert", F.col("MachinesInAlert") > 0)


def metric_band_series(view: DataFrame, threshold: float | None = DEFAULT_THRESHOLD) -> DataFrame:
    """Average line and min-max band per window and measure, in long form."""

    def point(measure: str) -> Column:
        limit = threshold if measure == "Temperature" else None
        return F.struct(
            F.lit(measure).alias("Measure"),
            *[
                F.col(f"{stat}{measure}").cast("double").alias(stat)
                for stat in ("Average", "Minimum", "Maximum")
            ],
            F.lit(limit).cast("double").alias("Threshold"),
        )

    return view.select(
        "Machine", "WindowStart", F.inline(F.array(*[point(m) for m in MEASURES]))
    )


def machine_legend(view: DataFrame, colors: int = SERIES_COLORS) -> DataFrame:
    """Legend text and colour index per machine, machines in name order.

    The ranking runs over one row per machine, not over windows.
    """
    rank = F.row_number().over(Window.orderBy("Machine")) - 1
    return _alerts(view).select(
        "Machine",
        F.when(F.col("TemperatureAlert"), F.concat(F.lit(ALERT_MARK), "Machine"))
        .otherwise(F.col("Machine"))
        .alias("Legend"),
        (rank % colors).alias("ColorIndex"),
    )


def fleet_series(
    view: DataFrame, threshold: float | None = DEFAULT_THRESHOLD, colors: int = SERIES_COLORS
) -> DataFrame:
    """One average line per machine and measure with its legend and colour."""
    labelled = view.join(machine_legend(view, colors), "Machine")

    def point(measure: str) -> Column:
        limit = threshold if measure == "Temperature" else None
        return F.struct(
            F.lit(measure).alias("Measure"),
            F.col(f"Average{measure}").alias("Average"),
            F.lit(limit).cast("double").alias("Threshold"),
        )

    points = F.inline(F.array(*[point(m) for m in MEASURES]))
    return labelled.select("Machine", "Legend", "ColorIndex", "WindowStart", points)


def _stamp(column: str, pattern: str, missing: str) -> Column:
    return F.coalesce(F.date_format(F.col(column), pattern), F.lit(missing))


def _windows_text() -> Column:
    return F.concat(F.col("Windows").cast("string"), F.lit(" two-minute windows"))


def machine_display(kpis: DataFrame) -> DataFrame:
    """``machine_kpis`` as display text."""
    return kpis.select(
        "Machine",
        F.col("TotalRecords").cast("string").alias("RecordsText"),
        _windows_text().alias("WindowsText"),
        fixed(F.col("AverageCurrent"), "A").alias("CurrentText"),
        fixed(F.col("AverageVoltage"), "V").alias("VoltageText"),
        fixed(F.col("AverageTemperature"), "°C").alias("TemperatureText"),
        _stamp("ProcessingDate", "dd/MM/yyyy HH:mm:ss", NOT_INFORMED).alias("LastProcessing"),
    )


def fleet_display(kpis: DataFrame) -> DataFrame:
    """``fleet_kpis`` as display text."""
    return kpis.select(
        F.col("TotalRecords").cast("string").alias("RecordsText"),
        _windows_text().alias("WindowsText"),
        F.col("Machines").cast("string").alias("MachinesText"),
        F.col("MachinesInAlert").cast("string").alias("AlertsText"),
        _stamp("LatestProcessing", "HH:mm:ss", NO_VALUE).alias("ProcessingTime"),
        _stamp("LatestProcessing", "dd/MM/yyyy", NOT_INFORMED).alias("ProcessingDay"),
        _stamp("LatestProcessing", "dd/MM/yyyy HH:mm:ss", NOT_INFORMED).alias("LastProcessing"),
    )


def fleet_status(kpis: DataFrame) -> DataFrame:
    """Message and severity for the fleet; an empty period is a warning."""
    none = F.col("Windows") == 0
    alert = F.col("HasTemperatureAlert")
    severity = F.when(alert, "danger").otherwise("success")
    showing = F.concat(
        F.lit("Showing average metrics for "), F.col("Machines").cast("string"), F.lit(" machines.")
    )
    return kpis.select(
        F.lit(ALL_MACHINES).alias("Scope"),
        F.when(none, NO_METRICS).otherwise(showing).alias("Message"),
        F.when(none, "warning").otherwise(severity).alias("MessageSeverity"),
        F.when(~none, F.when(alert, FLEET_ALERT).otherwise(FLEET_IN_RANGE)).alias("AlertText"),
        F.when(~none, severity).alias("AlertSeverity"),
    )


def machine_status(kpis: DataFrame) -> DataFrame:
    """Message and severity per machine; the message itself is never an alarm."""
    alert = F.col("TemperatureAlert")
    return kpis.select(
        F.col("Machine").alias("Scope"),
        F.concat(F.lit("Showing metrics from machine "), "Machine", F.lit(".")).alias("Message"),
        F.lit("success").alias("MessageSeverity"),
        F.when(alert, MACHINE_ALERT).otherwise(MACHINE_IN_RANGE).alias("AlertText"),
        F.when(alert, "danger").otherwise("success").alias("AlertSeverity"),
    )
