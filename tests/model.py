"""A brute-force model of the refresh rules, row by row in Python."""

from collections import defaultdict
from datetime import datetime, timedelta

from fleetmetrics.schemas import RAW

LOAD = datetime(2024, 1, 1)


def at(text: str, day: int = 1) -> datetime:
    return datetime.fromisoformat(f"2024-01-{day:02d} {text}")


def reading(source_id, machine, when, temperature=70, current=10.0, voltage=220.0):
    return (source_id, machine, current, voltage, temperature, when, LOAD)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW)


def start_of(when: datetime, length: int) -> datetime:
    hour = when.replace(minute=0, second=0, microsecond=0)
    return hour + timedelta(minutes=length * (when.minute // length))


class Model:
    def __init__(self):
        self.raw, self.metrics, self.control = {}, {}, {}

    def load(self, rows):
        for row in rows:
            self.raw.setdefault(row[:2], row)

    def refresh(self, as_of, threshold=85, length=2, watermark=15):
        span = timedelta(minutes=length)
        closed = []
        for row in self.raw.values():
            cursor = self.control.get(row[1], (None,))[0]
            if cursor is None:
                due = row[5] >= as_of - timedelta(days=1)
            else:
                due = row[0] > cursor
            if due and start_of(row[5], length) + span <= as_of - timedelta(seconds=watermark):
                closed.append(row)
        windows = {(row[1], start_of(row[5], length)) for row in closed}
        by_machine = defaultdict(list)
        for row in self.raw.values():
            by_machine[row[1]].append(row)
        for machine, start in windows:
            rows = [r for r in by_machine[machine] if start <= r[5] < start + span]
            temperatures = [r[4] for r in rows]
            self.metrics[machine, start, start + span] = (
                min(r[0] for r in rows),
                max(r[0] for r in rows),
                len(rows),
                round(sum(r[2] for r in rows) / len(rows), 6),
                round(sum(temperatures) / len(rows), 6),
                min(temperatures),
                max(temperatures),
                max(temperatures) >= threshold,
                as_of,
            )
        highest = defaultdict(int)
        for row in closed:
            highest[row[1]] = max(highest[row[1]], row[0])
        for machine, cursor in highest.items():
            old = self.control.get(machine, (0,))[0]
            self.control[machine] = (max(old, cursor), as_of)
        return len(windows), len(highest)


def stored_metrics(store):
    return {
        (r.strMachineName, r.dtWindowStart, r.dtWindowEnd): (
            r.nFirstSourceId,
            r.nLastSourceId,
            r.nRecords,
            round(r.fAverageCurrent, 6),
            round(r.fAverageTemperature, 6),
            r.nMinimumTemperature,
            r.nMaximumTemperature,
            r.bTemperatureAlert,
            r.dtProcessing,
        )
        for r in store.metrics().collect()
    }


def stored_control(store):
    return {
        r.strMachineName: (r.nLastProcessedSourceId, r.dtLastProcessing)
        for r in store.control().collect()
    }
