"""The registered queries in plain SQL, for checking against another engine.

Windows are found by their definition (hour plus whole window lengths, then a
range join), not by the way the Spark operators compute them.
"""

MEASURES = ("Current", "Voltage", "Temperature")

INPUTS = """
cadence_buffer AS (
  SELECT event_id,
         event_id + 1 AS nId,
         'Machine' || CAST(event_id % 5 + 1 AS VARCHAR) AS strMachineName,
         CAST(8.0 AS DOUBLE) + value % 6 AS fA,
         CAST(216 + event_id % 9 AS DOUBLE) AS fV,
         CAST(70 + (event_id % 5) * 3 + (event_id // 300) % 4 AS DOUBLE)
           + CAST(event_id % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS nTemperature,
         TIMESTAMP '2024-01-01 00:00:00'
           + to_seconds(2 * (event_id // 5) - CASE WHEN event_id % 97 = 96 THEN 300 ELSE 0 END)
           AS dtInsert
  FROM events),
cadence AS (
  SELECT nId AS nSourceId, strMachineName, fA AS fCurrent, fV AS fVoltage,
         CAST(round(nTemperature) AS INTEGER) AS nTemperature, dtInsert,
         dtInsert + to_seconds(nId % 60) AS dtLoad
  FROM cadence_buffer),
native AS (
  SELECT event_id + 1 AS nSourceId,
         'Machine' || CAST(user_id % 5 + 1 AS VARCHAR) AS strMachineName,
         value AS fCurrent, CAST(216 + event_id % 9 AS DOUBLE) AS fVoltage,
         CAST(props ->> '$.k' AS INTEGER) AS nTemperature, ts AS dtInsert,
         ts + to_seconds((event_id + 1) % 60) AS dtLoad
  FROM events),
clock AS (SELECT max(dtInsert) AS now FROM cadence),
half AS (SELECT max(nSourceId) // 2 AS id FROM cadence),
control AS (
  SELECT strMachineName, (SELECT id FROM half) AS cursor_id, min(dtInsert) AS seen
  FROM cadence WHERE strMachineName <> 'Machine5' GROUP BY 1),
no_control AS (SELECT * FROM control WHERE false),
message_kind AS (
  SELECT *, CASE WHEN event_id % 50 = 49 THEN (event_id // 50) % 10 END AS broken,
         CASE WHEN event_id % 50 = 24 THEN (event_id // 50) % 4 END AS unusual
  FROM cadence_buffer),
received AS (
  SELECT nId,
         CASE unusual WHEN 1 THEN '7' ELSE strMachineName END AS strMachineName,
         CASE unusual WHEN 0 THEN CAST(1.5 AS DOUBLE) ELSE fA END AS fA,
         CASE unusual WHEN 3 THEN CAST(230 AS DOUBLE) ELSE fV END AS fV,
         nTemperature, dtInsert
  FROM message_kind WHERE broken IS NULL),
numbered AS (
  SELECT row_number() OVER (ORDER BY nId) AS nId, strMachineName, fA, fV, nTemperature, dtInsert
  FROM received)
"""


def _measures(digits: int | None = 6) -> str:
    parts = []
    for measure in MEASURES:
        column = ("n" if measure == "Temperature" else "f") + measure
        average = f"avg(r.{column})" if digits is None else f"round(avg(r.{column}), {digits})"
        parts.append(
            f"{average} AS fAverage{measure}, min(r.{column}) AS {column[0]}Minimum{measure}, "
            f"max(r.{column}) AS {column[0]}Maximum{measure}"
        )
    return ", ".join(parts)


def _start(ts: str, length: int) -> str:
    return (
        f"date_trunc('hour', {ts}) + to_minutes({length} * (extract('minute' FROM {ts}) // {length}))"
    )


def _aggregate(wanted: str, readings: str, length: int = 2, digits: int | None = 6) -> str:
    """Metrics of the wanted (machine, window) pairs by a range join."""
    return f"""
      SELECT a.strMachineName, a.dtWindowStart,
             a.dtWindowStart + to_minutes({length}) AS dtWindowEnd,
             min(r.nSourceId) AS nFirstSourceId, max(r.nSourceId) AS nLastSourceId,
             CAST(count(*) AS INTEGER) AS nRecords, {_measures(digits)}
      FROM ({wanted}) a JOIN {readings} r
        ON r.strMachineName = a.strMachineName AND r.dtInsert >= a.dtWindowStart
       AND r.dtInsert < a.dtWindowStart + to_minutes({length})
      GROUP BY a.strMachineName, a.dtWindowStart"""


def _every_window(readings: str, length: int = 2) -> str:
    return f"SELECT DISTINCT strMachineName, {_start('dtInsert', length)} AS dtWindowStart FROM {readings}"


def _due(readings: str, control: str, now: str) -> str:
    return f"""
      SELECT r.* FROM {readings} r LEFT JOIN {control} c ON c.strMachineName = r.strMachineName
      WHERE CASE WHEN c.cursor_id IS NULL THEN r.dtInsert >= {now} - INTERVAL 1 DAY
                 ELSE r.nSourceId > c.cursor_id END"""


def _refresh(
    name: str, readings: str, control: str, now: str, length: int = 2, threshold: int = 85
) -> str:
    """CTEs of one refresh: its closed readings, metrics and cursors."""
    return f"""
{name}_due AS ({_due(readings, control, now)}),
{name}_placed AS (SELECT *, {_start('dtInsert', length)} AS dtWindowStart FROM {name}_due),
{name}_closed AS (
  SELECT * FROM {name}_placed
  WHERE dtWindowStart + to_minutes({length}) <= {now} - INTERVAL 15 SECOND),
{name}_windows AS (SELECT DISTINCT strMachineName, dtWindowStart FROM {name}_closed),
{name}_metrics AS (
  SELECT m.*, nMaximumTemperature >= {threshold} AS bTemperatureAlert, {now} AS dtProcessing
  FROM ({_aggregate(f'SELECT * FROM {name}_windows', readings, length)}) m),
{name}_cursors AS (
  SELECT strMachineName, max(nSourceId) AS cursor_id, {now} AS seen
  FROM {name}_closed GROUP BY strMachineName)"""


# The columns of the metrics table under their display names.
VIEW_COLUMNS = """
  strMachineName AS Machine, dtWindowStart AS WindowStart, dtWindowEnd AS WindowEnd,
  nFirstSourceId AS FirstSourceId, nLastSourceId AS LastSourceId, nRecords AS Records,
  fAverageCurrent AS AverageCurrent, fMinimumCurrent AS MinimumCurrent,
  fMaximumCurrent AS MaximumCurrent, fAverageVoltage AS AverageVoltage,
  fMinimumVoltage AS MinimumVoltage, fMaximumVoltage AS MaximumVoltage,
  fAverageTemperature AS AverageTemperature, nMinimumTemperature AS MinimumTemperature,
  nMaximumTemperature AS MaximumTemperature, bTemperatureAlert AS TemperatureAlert,
  dtProcessing AS ProcessingDate"""


def _finished(name: str, readings: str, threshold: int = 85) -> str:
    """Metrics of every window, and the same under the display names."""
    return f"""
{name} AS (
  SELECT m.*, nMaximumTemperature >= {threshold} AS bTemperatureAlert,
         dtWindowEnd + INTERVAL 75 SECOND AS dtProcessing
  FROM ({_aggregate(_every_window(readings), readings, digits=None)}) m),
{name}_view AS (SELECT {VIEW_COLUMNS} FROM {name}),
{name}_last AS (
  SELECT * FROM {name}_view v WHERE NOT EXISTS (
    SELECT 1 FROM {name}_view w WHERE w.Machine = v.Machine AND w.WindowStart > v.WindowStart))"""


ROUND_VIEW = (
    "* REPLACE (round(AverageCurrent, 6) AS AverageCurrent, "
    "round(AverageVoltage, 6) AS AverageVoltage, "
    "round(AverageTemperature, 6) AS AverageTemperature)"
)


def _query(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([INPUTS, *ctes]) + body


NOW = "(SELECT now FROM clock)"
STATE = _refresh("run", "cadence", "control", NOW)
FIRST = _refresh("run", "cadence", "no_control", NOW)
DONE = _finished("done", "cadence")
HOT = _finished("done", "cadence", threshold=80)

CLOSED_COLUMNS = (
    "nSourceId, strMachineName, fCurrent, fVoltage, nTemperature, dtInsert, dtLoad, dtWindowStart"
)

LATE = f"""
early AS (SELECT * FROM cadence WHERE nSourceId <= (SELECT id FROM half)),
{_refresh("one", "early", "no_control", "(SELECT max(dtInsert) FROM early)")},
{_refresh("two", "cadence", "one_cursors", NOW)}"""

LATE_METRICS = """
SELECT * FROM two_metrics UNION ALL BY NAME
SELECT * FROM one_metrics o WHERE NOT EXISTS (
  SELECT 1 FROM two_metrics t WHERE t.strMachineName = o.strMachineName
  AND t.dtWindowStart = o.dtWindowStart)"""

LATE_VIEW = f"""
late AS ({LATE_METRICS}),
done_view AS (
  SELECT {VIEW_COLUMNS} FROM late WHERE dtWindowStart >= {NOW} - INTERVAL 60 MINUTE),
done_last AS (
  SELECT * FROM done_view v WHERE NOT EXISTS (
    SELECT 1 FROM done_view w WHERE w.Machine = v.Machine AND w.WindowStart > v.WindowStart))"""

FLEET_KPIS = """
SELECT CAST(sum(Records) AS BIGINT) AS TotalRecords, count(*) AS Windows,
    count(DISTINCT Machine) AS Machines, max(ProcessingDate) AS LatestProcessing,
    (SELECT count(*) FROM done_last WHERE TemperatureAlert) AS MachinesInAlert,
    (SELECT count(*) FROM done_last WHERE TemperatureAlert) > 0 AS HasTemperatureAlert
  FROM done_view"""

MACHINE_KPIS = """
SELECT v.Machine, CAST(sum(v.Records) AS BIGINT) AS TotalRecords,
    count(*) AS Windows,
    round(any_value(l.AverageCurrent), 6) AS AverageCurrent,
    round(any_value(l.AverageVoltage), 6) AS AverageVoltage,
    round(any_value(l.AverageTemperature), 6) AS AverageTemperature,
    any_value(l.TemperatureAlert) AS TemperatureAlert,
    any_value(l.ProcessingDate) AS ProcessingDate
  FROM done_view v JOIN done_last l ON l.Machine = v.Machine GROUP BY v.Machine"""

NIGHT = "(SELECT date_trunc('day', max(ts)) + INTERVAL 30 MINUTE FROM events)"

# Readings of the second half whose window had ended by the watermark of the first.
KEPT = f"""
kept AS (
  SELECT * FROM cadence
  WHERE nSourceId <= (SELECT id FROM half)
     OR {_start('dtInsert', 2)} + INTERVAL 2 MINUTE
        > (SELECT max(dtInsert) FROM cadence WHERE nSourceId <= (SELECT id FROM half))
          - INTERVAL 15 SECOND)"""

STATUS = """
fleet AS (
  SELECT count(DISTINCT Machine) AS machines, count(*) AS windows,
         (SELECT count(*) FROM done_last WHERE TemperatureAlert) AS alerts
  FROM done_view)"""


def _band(measure: str, limit: str) -> str:
    return f"""
      SELECT Machine, WindowStart, '{measure}' AS Measure,
             round(Average{measure}, 6) AS Average,
             CAST(Minimum{measure} AS DOUBLE) AS Minimum,
             CAST(Maximum{measure} AS DOUBLE) AS Maximum,
             CAST({limit} AS DOUBLE) AS Threshold
      FROM done_view"""


def _line(measure: str, limit: str) -> str:
    return f"""
      SELECT v.Machine, l.Legend, l.ColorIndex, v.WindowStart, '{measure}' AS Measure,
             round(v.Average{measure}, 6) AS Average, CAST({limit} AS DOUBLE) AS Threshold
      FROM done_view v JOIN legend l ON l.Machine = v.Machine"""


def _delay(rows: str, earlier: str, later: str, count: str) -> str:
    seconds = f"date_diff('second', {earlier}, {later})"
    return f"""
      SELECT strMachineName, count(*) AS {count}, round(avg({seconds}), 6) AS AverageSeconds,
             min({seconds}) AS MinimumSeconds, max({seconds}) AS MaximumSeconds
      FROM {rows} GROUP BY strMachineName"""


#: Queries that come to a result by another way.
SAME_RESULT = {
    "concurrent_ingest": "ingest_job",
    "recompute_partials": "recompute_windows",
    "late_recompute_clustered": "late_recompute",
    "period_hierarchy": "period_rollup",
    "interval_append": "idempotent_append",
    "stream_refresh_keyed": "stream_refresh",
}


def oracle_sql() -> dict[str, str]:
    periods = {60: "Last hour", 360: "Last 6 hours", 720: "Last 12 hours", 1440: "Last 24 hours"}
    found = {
        "decode_messages": _query("SELECT * FROM received"),
        "quarantine_messages": _query(
            """SELECT nId,
                 CASE WHEN broken <= 3 THEN 'invalid_json' WHEN broken = 4 THEN 'missing_field'
                      ELSE 'constraint' END AS reject_reason,
                 CASE broken WHEN 4 THEN 'fV' WHEN 5 THEN 'strMachineName' WHEN 6 THEN 'fA'
                      WHEN 7 THEN 'fA' WHEN 8 THEN 'dtInsert' WHEN 9 THEN 'strMachineName'
                 END AS reject_field
               FROM message_kind WHERE broken IS NOT NULL"""
        ),
        "encode_messages": _query(
            """SELECT nId, '{"strMachineName":"' || strMachineName || '","fA":' || fA || ',"fV":'
                 || fV || ',"nTemperature":' || nTemperature || ',"dtNow":"'
                 || strftime(dtInsert, '%Y-%m-%d %H:%M:%S') || '"}' AS value
               FROM cadence_buffer"""
        ),
        "assign_source_ids": """
            SELECT 1000 + row_number() OVER (ORDER BY event_id) AS nId, event_id, ts, value
            FROM events""",
        "constraint_violations": _query(
            """SELECT nId, CASE nId % 40 WHEN 2 THEN 'fA' WHEN 3 THEN 'fV'
                 WHEN 4 THEN 'nTemperature' WHEN 5 THEN 'dtInsert' ELSE 'strMachineName'
               END AS reject_field
               FROM cadence_buffer WHERE nId % 40 BETWEEN 1 AND 6"""
        ),
        "ingest_cursor": _query("SELECT coalesce(max(nSourceId), 0) AS nLastSourceId FROM cadence"),
        "incremental_scan": _query(
            """SELECT nId AS nSourceId, strMachineName, fA AS fCurrent, fV AS fVoltage,
                 nTemperature, dtInsert
               FROM cadence_buffer WHERE nId > (SELECT id FROM half)"""
        ),
        "temperature_rounding": _query(
            """SELECT nId, nTemperature - 75 AS nMeasured,
                 CAST(round(nTemperature - 75) AS INTEGER) AS nTemperature
               FROM cadence_buffer"""
        ),
        "idempotent_append": _query(
            "SELECT * FROM cadence WHERE nSourceId > (SELECT id FROM half)"
        ),
        "ingest_job": _query(
            f"SELECT * REPLACE ({NOW} AS dtLoad) FROM cadence"
        ),
        "ingest_text_buffer": _query(
            f"SELECT * REPLACE ({NOW} AS dtLoad) FROM cadence WHERE nSourceId % 40 NOT BETWEEN 1 AND 5"
        ),
        "ingest_text_refused": _query(
            """SELECT nId, CASE nId % 40 WHEN 1 THEN 'dtInsert' WHEN 2 THEN 'strMachineName'
                 WHEN 3 THEN 'fCurrent' WHEN 4 THEN 'nTemperature' ELSE 'strMachineName' END
                 AS reject_field
               FROM cadence_buffer WHERE nId % 40 BETWEEN 1 AND 5"""
        ),
        "assign_windows": _query(
            f"""SELECT nSourceId, strMachineName, dtInsert, {_start('dtInsert', 2)} AS dtStart2,
                  {_start('dtInsert', 7)} AS dtStart7
                FROM native"""
        ),
        "candidate_readings": _query(f"SELECT * FROM ({_due('cadence', 'control', NOW)})"),
        "candidate_readings_native": _query(
            f"SELECT * FROM ({_due('native', 'native_control', '(SELECT max(ts) FROM events)')})",
            """native_control AS (
                 SELECT DISTINCT strMachineName, (SELECT max(nSourceId) // 2 FROM native) AS cursor_id
                 FROM native WHERE strMachineName <> 'Machine5')""",
        ),
        "closed_window_readings": _query(f"SELECT {CLOSED_COLUMNS} FROM run_closed", STATE),
        "affected_windows": _query("SELECT * FROM run_windows", STATE),
        "recompute_windows": _query(
            "SELECT * EXCLUDE (bTemperatureAlert, dtProcessing) FROM run_metrics", STATE
        ),
        "recompute_overlapping": _query(
            "SELECT * EXCLUDE (bTemperatureAlert, dtProcessing) FROM run_metrics",
            _refresh("run", "cadence", "control", NOW, length=7),
        ),
        "window_metrics": _query(
            f"SELECT * FROM ({_aggregate(_every_window('cadence'), 'cadence')})"
        ),
        "temperature_alerts": _query(
            "SELECT strMachineName, dtWindowStart, nMaximumTemperature, bTemperatureAlert FROM done",
            DONE,
        ),
        "processed_sources": _query(
            "SELECT strMachineName, cursor_id AS nLastProcessedSourceId FROM run_cursors", STATE
        ),
        "successful_machines": _query(
            """SELECT strMachineName, cursor_id AS nLastProcessedSourceId FROM run_cursors
               WHERE strMachineName IN (SELECT strMachineName FROM done WHERE bTemperatureAlert)""",
            STATE,
            DONE,
        ),
        "refresh_metrics": _query("SELECT * FROM run_metrics", STATE),
        "refresh_first_load": _query("SELECT * FROM run_metrics", FIRST),
        "refresh_below_open": _query(
            f"""SELECT coalesce(n.strMachineName, c.strMachineName) AS strMachineName,
                  greatest(c.cursor_id, least(n.cursor_id, o.first_open - 1))
                    AS nLastProcessedSourceId,
                  coalesce(n.seen, c.seen) AS dtLastProcessing
                FROM control c FULL JOIN run_cursors n ON n.strMachineName = c.strMachineName
                LEFT JOIN (
                  SELECT strMachineName, min(nSourceId) AS first_open FROM run_placed
                  WHERE dtWindowStart + INTERVAL 2 MINUTE > {NOW} - INTERVAL 15 SECOND
                  GROUP BY 1) o
                  ON o.strMachineName = coalesce(n.strMachineName, c.strMachineName)""",
            STATE,
        ),
        "refresh_summary": _query(
            """SELECT (SELECT count(*) FROM run_metrics) AS nProcessedMetrics,
                      (SELECT count(*) FROM run_cursors) AS nUpdatedMachines""",
            STATE,
        ),
        "upsert_metrics": _query(
            """SELECT * FROM run_metrics UNION ALL BY NAME
               SELECT * REPLACE (round(fAverageCurrent, 6) AS fAverageCurrent,
                                 round(fAverageVoltage, 6) AS fAverageVoltage,
                                 round(fAverageTemperature, 6) AS fAverageTemperature)
               FROM first_half f WHERE NOT EXISTS (
                 SELECT 1 FROM run_metrics u WHERE u.strMachineName = f.strMachineName
                 AND u.dtWindowStart = f.dtWindowStart AND u.dtWindowEnd = f.dtWindowEnd)""",
            STATE,
            "early AS (SELECT * FROM cadence WHERE nSourceId <= (SELECT id FROM half))",
            _finished("first_half", "early"),
        ),
        "upsert_control": _query(
            """SELECT coalesce(n.strMachineName, c.strMachineName) AS strMachineName,
                 greatest(c.cursor_id, n.cursor_id) AS nLastProcessedSourceId,
                 coalesce(n.seen, c.seen) AS dtLastProcessing
               FROM control c FULL JOIN run_cursors n ON n.strMachineName = c.strMachineName""",
            STATE,
        ),
        "late_recompute": _query(LATE_METRICS, LATE),
        "metrics_last_period": _query(
            f"""SELECT {ROUND_VIEW} FROM done_view
                WHERE WindowStart >= {NOW} - INTERVAL 60 MINUTE""",
            DONE,
        ),
        "period_view_store": _query(
            f"""SELECT {ROUND_VIEW} FROM (SELECT {VIEW_COLUMNS} FROM run_metrics)
                WHERE WindowStart >= {NIGHT} - INTERVAL 60 MINUTE""",
            _refresh("run", "native", "no_control", NIGHT),
        ),
        "period_rollup": _query(
            " UNION ALL ".join(
                f"""SELECT CAST({p} AS INTEGER) AS PeriodMinutes, '{label}' AS Label,
                      count(*) AS Windows, CAST(coalesce(sum(Records), 0) AS BIGINT) AS Records
                    FROM done_view
                    WHERE WindowStart >= (SELECT max(ts) FROM events) - INTERVAL {p} MINUTE"""
                for p, label in periods.items()
            ),
            _finished("done", "native"),
        ),
        "machine_list": _query(
            """SELECT CAST(0 AS INTEGER) AS Rank, 'All machines' AS Label, '__all__' AS Value
               UNION ALL
               SELECT DISTINCT CAST(1 AS INTEGER), Machine, Machine FROM done_view""",
            DONE,
        ),
        "machine_series": _query(
            f"SELECT {ROUND_VIEW} FROM done_view WHERE Machine = 'Machine3'", DONE
        ),
        "selected_machine": _query(
            "SELECT Machine, count(*) AS Windows FROM done_view GROUP BY Machine", DONE
        ),
        "latest_per_machine": _query(f"SELECT {ROUND_VIEW} FROM done_last", DONE),
        "machines_in_alert": _query("SELECT Machine FROM done_last WHERE TemperatureAlert", HOT),
        "fleet_kpis": _query(FLEET_KPIS, DONE),
        "machine_kpis": _query(MACHINE_KPIS, DONE),
        "kept_fleet_kpis": _query(FLEET_KPIS, LATE, LATE_VIEW),
        "kept_machine_kpis": _query(MACHINE_KPIS, LATE, LATE_VIEW),
        "metric_band_series": _query(
            " UNION ALL ".join(
                _band(m, "85" if m == "Temperature" else "NULL") for m in MEASURES
            ),
            DONE,
        ),
        "fleet_series": _query(
            " UNION ALL ".join(
                _line(m, "80" if m == "Temperature" else "NULL") for m in MEASURES
            ),
            HOT,
            """legend AS (
                 SELECT Machine, CASE WHEN TemperatureAlert THEN '🚨 ' ELSE '' END || Machine AS Legend,
                   CAST((row_number() OVER (ORDER BY Machine) - 1) % 10 AS INTEGER) AS ColorIndex
                 FROM done_last)""",
        ),
        "kpi_display": _query(
            """SELECT v.Machine, CAST(sum(v.Records) AS VARCHAR) AS RecordsText,
                 count(*) || ' two-minute windows' AS WindowsText,
                 printf('%.2f A', any_value(l.AverageCurrent)) AS CurrentText,
                 printf('%.2f V', any_value(l.AverageVoltage)) AS VoltageText,
                 printf('%.2f °C', any_value(l.AverageTemperature)) AS TemperatureText,
                 strftime(any_value(l.ProcessingDate), '%d/%m/%Y %H:%M:%S') AS LastProcessing
               FROM done_view v JOIN done_last l ON l.Machine = v.Machine GROUP BY v.Machine""",
            DONE,
        ),
        "fleet_display": _query(
            """SELECT CAST(sum(Records) AS VARCHAR) AS RecordsText,
                 count(*) || ' two-minute windows' AS WindowsText,
                 CAST(count(DISTINCT Machine) AS VARCHAR) AS MachinesText,
                 CAST((SELECT count(*) FROM done_last WHERE TemperatureAlert) AS VARCHAR)
                   AS AlertsText,
                 strftime(max(ProcessingDate), '%H:%M:%S') AS ProcessingTime,
                 strftime(max(ProcessingDate), '%d/%m/%Y') AS ProcessingDay,
                 strftime(max(ProcessingDate), '%d/%m/%Y %H:%M:%S') AS LastProcessing
               FROM done_view""",
            DONE,
        ),
        "fleet_status": _query(
            """SELECT '__all__' AS Scope,
                 CASE WHEN windows = 0 THEN 'No metrics found for the selected time range.'
                   ELSE 'Showing average metrics for ' || machines || ' machines.' END AS Message,
                 CASE WHEN windows = 0 THEN 'warning' WHEN alerts > 0 THEN 'danger'
                   ELSE 'success' END AS MessageSeverity,
                 CASE WHEN windows = 0 THEN NULL WHEN alerts > 0
                   THEN '🚨 Check highlighted machines'
                   ELSE 'All machines within the acceptable range' END AS AlertText,
                 CASE WHEN windows = 0 THEN NULL WHEN alerts > 0 THEN 'danger'
                   ELSE 'success' END AS AlertSeverity
               FROM fleet
               UNION ALL
               SELECT Machine, 'Showing metrics from machine ' || Machine || '.', 'success',
                 CASE WHEN TemperatureAlert THEN '🚨 Temperature alert active'
                   ELSE 'Temperature within the acceptable range' END,
                 CASE WHEN TemperatureAlert THEN 'danger' ELSE 'success' END
               FROM done_last""",
            HOT,
            STATUS,
        ),
        "ingestion_latency": _query(_delay("cadence", "dtInsert", "dtLoad", "Readings")),
        "processing_delay": _query(_delay("done", "dtWindowEnd", "dtProcessing", "Windows"), DONE),
        "stream_readings": _query("SELECT * FROM numbered"),
        "stream_message_log": _query("SELECT strMachineName, fA, fV, nTemperature, dtInsert FROM numbered"),
        "stream_ingest": _query(
            f"""SELECT nId AS nSourceId, strMachineName, fA AS fCurrent, fV AS fVoltage,
                  CAST(round(nTemperature) AS INTEGER) AS nTemperature, dtInsert, {NOW} AS dtLoad
                FROM numbered"""
        ),
        "stream_refresh": _query("SELECT * FROM run_metrics", FIRST),
        "stream_window_native": _query(
            f"""SELECT * FROM ({_aggregate(_every_window('kept'), 'kept')})
                WHERE dtWindowEnd <= {NOW} - INTERVAL 15 SECOND""",
            KEPT,
        ),
    }
    return found | {name: found[other] for name, other in SAME_RESULT.items()}
