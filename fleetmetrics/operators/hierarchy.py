"""Totals of windows over 1, 2, 4, 8 ... minutes, from which any period is put together.

A node of level k holds the totals of one machine's windows that start in one
stretch of 2**k minutes, counted from 1970. Any period is the sum of at most two
nodes a level, however many windows it holds. Windows start on full minutes.

Totals are counts and whole sums, so a changed window is a row with the
difference: nodes can be kept up to date without the windows that did not change,
and an alert that a recompute takes back is taken back in the nodes.
"""

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmetrics.operators.fleet import PERIODS

#: The highest level: 2,048 minutes, the first that is longer than a day.
TOP = 11
NODE_KEY = ("strMachineName", "nLevel", "nNode")
TOTALS = ("nWindows", "nRecords", "nAlerts")
_EPOCH = datetime(1970, 1, 1)
#: Level, first node, and the node after the last; None if there is no end.
Stretch = tuple[int, int, int | None]


def minute_number(ts: Column) -> Column:
    """Full minutes since 1970 of a time without zone."""
    days = F.datediff(F.to_date(ts), F.to_date(F.lit("1970-01-01"))).cast("long")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def _totals(rows: DataFrame, sign: int = 1) -> DataFrame:
    """A machine's totals for each window start; without machine or start, rows count nowhere."""
    counted = {
        "nWindows": F.lit(1),
        "nRecords": F.coalesce(F.col("nRecords"), F.lit(0)),
        "nAlerts": F.coalesce(F.col("bTemperatureAlert"), F.lit(False)).cast("int"),
    }
    known = rows.dropna(subset=["strMachineName", "dtWindowStart"])
    return known.select(
        "strMachineName",
        minute_number(F.col("dtWindowStart")).alias("minute"),
        *[(sign * c.cast("long")).alias(name) for name, c in counted.items()],
    )


def _summed(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*NODE_KEY).agg(*[F.sum(c).alias(c) for c in TOTALS])
    return sums.filter(" OR ".join(f"{c} <> 0" for c in TOTALS))


def _nodes(totals: DataFrame, top: int) -> DataFrame:
    """All levels in one exchange: rows of a node are added up before they are sent."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("nLevel")
    placed = totals.select("*", levels)
    node = F.expr("shiftright(minute, nLevel)").alias("nNode")
    return _summed(placed.select("strMachineName", "nLevel", node, *TOTALS))


def window_nodes(metrics: DataFrame, top: int = TOP) -> DataFrame:
    """NODE_KEY and TOTALS of all nodes that are not empty."""
    return _nodes(_totals(metrics), top)


def changed_nodes(before: DataFrame, after: DataFrame, top: int = TOP) -> DataFrame:
    """What a change of windows adds to each node; ``before`` and ``after`` are the changed ones."""
    return _nodes(_totals(before, -1).unionByName(_totals(after)), top)


def with_changes(nodes: DataFrame, *changes: DataFrame) -> DataFrame:
    """Nodes after changes. Changes that cancel out leave no row."""
    for change in changes:
        nodes = nodes.unionByName(change)
    return _summed(nodes)


def write_nodes(nodes: DataFrame, folder: str) -> None:
    """A folder for each level, sorted by time: few row groups hold the nodes of a period."""
    laid = nodes.repartitionByRange("nLevel", "nNode").sortWithinPartitions("nLevel", "nNode")
    laid.write.partitionBy("nLevel").parquet(folder)


def _minute(moment: datetime) -> int:
    """The first full minute at or after the moment."""
    return -((_EPOCH - moment) // timedelta(minutes=1))


def stretches(start: datetime, stop: datetime | None = None, top: int = TOP) -> list[Stretch]:
    """The nodes that make up [start, stop): one to a level on the way up and down, and a
    run of the highest ones."""
    low, high = _minute(start), None if stop is None else _minute(stop)
    up: list[Stretch] = []
    down: list[Stretch] = []
    for level in range(top):
        if high is not None and low >= high:
            return up + down
        if low & 1:
            up.append((level, low, low + 1))
            low += 1
        if high is not None and high & 1 and high > low:
            high -= 1
            down.append((level, high, high + 1))
        low >>= 1
        high = None if high is None else high >> 1
    if high is None or low < high:
        up.append((top, low, high))
    return up + down


def within(parts: Sequence[Stretch]) -> Column:
    """Whether a node is one of these; such a filter reaches the scan of the nodes."""
    found = F.lit(False)
    for level, low, high in parts:
        one = (F.col("nLevel") == level) & (F.col("nNode") >= low)
        found = found | (one if high is None else one & (F.col("nNode") < high))
    return found


def machine_totals(nodes: DataFrame, start: datetime, stop: datetime | None = None, top: int = TOP) -> DataFrame:
    """TOTALS of each machine that has windows starting in [start, stop)."""
    held = nodes.filter(within(stretches(start, stop, top)))
    sums = held.groupBy("strMachineName").agg(*[F.sum(c).alias(c) for c in TOTALS])
    return sums.filter("nWindows > 0")


def period_totals(nodes: DataFrame, local_now: datetime, top: int = TOP) -> DataFrame:
    """As ``fleet.period_rollup``, from nodes."""
    parts = {p: stretches(local_now - timedelta(minutes=p), top=top) for p in PERIODS}
    held = nodes.filter(within(sorted({s for some in parts.values() for s in some}, key=str)))

    def total(name: str, period: int) -> Column:
        return F.coalesce(F.sum(F.when(within(parts[period]), F.col(name))), F.lit(0).cast("long"))

    totals = held.agg(*[total(c, p).alias(f"{c}_{p}") for p in PERIODS for c in ("nWindows", "nRecords")])
    rows = [
        F.struct(
            F.lit(p).alias("PeriodMinutes"),
            F.lit(label).alias("Label"),
            F.col(f"nWindows_{p}").alias("Windows"),
            F.col(f"nRecords_{p}").alias("Records"),
        )
        for p, label in PERIODS.items()
    ]
    return totals.select(F.inline(F.array(*rows)))
