"""Serving views: ties, nulls, empty periods and display."""

from datetime import timedelta

import pytest
from model import at

from fleetmetrics.operators import fleet, latency
from fleetmetrics.schemas import METRICS, RAW


def row(machine, start, length=2, records=1, average=10.0, alert=False, processed=None):
    end = None if start is None else start + timedelta(minutes=length)
    return (1, 2, machine, start, end, records, average, 1.0, 2.0, average, 1.0, 2.0, average, 1, 2,
            alert, processed)


def view(spark, *rows):
    return fleet.metrics_view(spark.createDataFrame(list(rows), METRICS))


def test_period_start_is_inclusive_and_open_ended(spark):
    now = at("12:00:00")
    rows = [row("M", at(t)) for t in ("10:59:59", "11:00:00", "13:00:00")]
    metrics = spark.createDataFrame(rows, METRICS)
    found = fleet.metrics_last_period(metrics, now)
    assert [r.WindowStart for r in found.collect()] == [at("11:00:00"), at("13:00:00")]
    assert fleet.last_period(metrics, now, None).count() == 2
    assert fleet.last_period(metrics, now, 0).count() == 2
    counts = {r.PeriodMinutes: r.Windows for r in fleet.period_rollup(metrics, now).collect()}
    assert counts == {60: 2, 360: 3, 720: 3, 1440: 3}


def test_rows_without_key_are_dropped_and_bad_times_become_null(spark):
    frame = view(spark, row("M", at("10:00:00")), row(None, at("10:00:00")), row("M", None))
    assert frame.count() == 1
    text = frame.withColumn("WindowEnd", frame.WindowEnd.cast("string"))
    broken = text.selectExpr("* except (ProcessingDate)", "'never' as ProcessingDate")
    cleaned = fleet.clean_view(broken).first()
    assert cleaned.ProcessingDate is None and cleaned.WindowEnd == at("10:02:00")


def test_latest_of_equal_starts_is_the_later_end(spark):
    frame = view(spark, row("M", at("10:00:00"), 7, 5), row("M", at("10:00:00"), 2, 9))
    assert fleet.latest_per_machine(frame).first().Records == 5


def test_unknown_alert_counts_as_none(spark):
    frame = view(
        spark,
        row("A", at("10:00:00"), alert=True),
        row("A", at("10:02:00"), alert=None),
        row("B", at("10:00:00"), alert=False),
        row("B", at("10:02:00"), alert=True),
    )
    assert [r.Machine for r in fleet.machines_in_alert(frame).collect()] == ["B"]
    kpis = fleet.fleet_kpis(frame).first()
    assert (kpis.Machines, kpis.Windows, kpis.MachinesInAlert) == (2, 4, 1)
    by_machine = {r.Machine: r.TemperatureAlert for r in fleet.machine_kpis(frame).collect()}
    assert by_machine == {"A": False, "B": True}


def test_fleet_shows_the_last_processing_and_a_machine_that_of_its_last_window(spark):
    frame = view(
        spark,
        row("M", at("10:00:00"), processed=at("15:00:00")),
        row("M", at("10:02:00"), processed=at("14:00:00")),
    )
    assert fleet.fleet_kpis(frame).first().LatestProcessing == at("15:00:00")
    assert fleet.machine_kpis(frame).first().ProcessingDate == at("14:00:00")


def test_menu_lists_all_machines_first(spark):
    frame = view(spark, *[row(m, at("10:00:00")) for m in "bBa"])
    found = [(r.Label, r.Value) for r in fleet.machine_list(frame).collect()]
    assert found == [("All machines", "__all__"), ("B", "B"), ("a", "a"), ("b", "b")]


@pytest.mark.parametrize(
    "selected, resolved", [("M", "M"), ("X", "__all__"), (None, "__all__"), ("__all__", "__all__")]
)
def test_selection_falls_back_to_all(spark, selected, resolved):
    frame = view(spark, row("M", at("10:00:00")), row("N", at("10:00:00")))
    assert fleet.resolve_selection(frame, selected) == resolved
    assert fleet.select_machine(frame, selected).count() == (1 if resolved == "M" else 2)


def test_empty_period_is_a_warning_with_zeros(spark):
    kpis = fleet.fleet_kpis(view(spark))
    found = kpis.first()
    assert (found.TotalRecords, found.Windows, found.Machines, found.MachinesInAlert) == (0,) * 4
    assert found.LatestProcessing is None and found.HasTemperatureAlert is False
    status = fleet.fleet_status(kpis).first()
    assert status.MessageSeverity == "warning" and status.AlertText is None
    shown = fleet.fleet_display(kpis).first()
    assert (shown.ProcessingTime, shown.ProcessingDay) == ("--", "Not informed")


def test_display(spark):
    frame = view(
        spark,
        row("M", at("10:00:00"), average=2.675, records=3, processed=at("09:05:07")),
        row("N", at("10:00:00"), average=None, alert=True),
    )
    shown = {r.Machine: r for r in fleet.machine_display(fleet.machine_kpis(frame)).collect()}
    assert shown["M"].CurrentText == "2.67 A" and shown["M"].TemperatureText == "2.67 °C"
    assert shown["M"].LastProcessing == "01/01/2024 09:05:07"
    assert shown["M"].WindowsText == "1 two-minute windows"
    assert shown["N"].VoltageText == "--" and shown["N"].LastProcessing == "Not informed"
    status = {r.Scope: r for r in fleet.machine_status(fleet.machine_kpis(frame)).collect()}
    assert status["N"].AlertSeverity == "danger" and status["N"].MessageSeverity == "success"


def test_series(spark):
    machines = [f"M{i:02d}" for i in range(12)]
    frame = view(spark, *[row(m, at("10:00:00"), alert=m == "M11") for m in machines])
    series = fleet.fleet_series(frame).filter("Measure = 'Temperature'").collect()
    assert {r.Machine: r.ColorIndex for r in series} == {m: i % 10 for i, m in enumerate(machines)}
    assert {r.Legend for r in series if r.Machine == "M11"} == {"🚨 M11"}
    band = fleet.metric_band_series(frame).filter("Machine = 'M00'").collect()
    assert {r.Measure: r.Threshold for r in band} == {
        "Current": None,
        "Voltage": None,
        "Temperature": 85.0,
    }


def test_delays_are_whole_seconds(spark):
    start = at("10:00:00")
    delays = (2.9, -1.9, 4, 90_000)
    rows = [
        (i, "M", 1.0, 1.0, 1, start, start + timedelta(seconds=s)) for i, s in enumerate(delays)
    ]
    found = latency.ingestion_latency(spark.createDataFrame(rows, RAW)).first()
    assert (found.MinimumSeconds, found.MaximumSeconds) == (-1, 90_000)
    assert found.AverageSeconds == (2 - 1 + 4 + 90_000) / 4
