"""Readings added up per machine and minute, and windows merged from such minutes.

Every window starts and ends on a full minute, so a window of any length is the
sum of its minutes, whichever loads they came in. A late reading then costs one
more small row instead of another look at all readings of its window.

Sums of doubles depend on their order. Here a value is split into two whole
numbers, its multiples of 2**-20 and of 2**-62, whose sums do not: averages
differ from the readings' true mean by rounding only. A value that two such
numbers cannot hold (2**43 or more, bits below 2**-62, no number) is counted in
``nInexact``, and its windows have to be computed from the readings.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.functions.clock import minutes, tiled_start
from fleetmetrics.operators.windows import WINDOW_KEY, cover_windows

COARSE = float(1 << 20)
FINE = float(1 << 62)
LIMIT = float(1 << 43)
SUM = T.DecimalType(38, 0)
_SUMMED = ("Current", "Voltage")

PARTIALS = T.StructType(
    [
        T.StructField("strMachineName", T.StringType()),
        T.StructField("dtMinute", T.TimestampNTZType()),
        T.StructField("nFirstSourceId", T.LongType()),
        T.StructField("nLastSourceId", T.LongType()),
        T.StructField("nRecords", T.LongType()),
        *[T.StructField(f"{part}{name}", SUM) for name in _SUMMED for part in ("dCoarse", "dFine")],
        T.StructField("nSumTemperature", T.LongType()),
        *[T.StructField(f"f{end}{name}", T.DoubleType()) for name in _SUMMED for end in ("Minimum", "Maximum")],
        T.StructField("nMinimumTemperature", T.IntegerType()),
        T.StructField("nMaximumTemperature", T.IntegerType()),
        T.StructField("nInexact", T.LongType()),
    ]
)


def _coarse(value: Column) -> Column:
    return F.rint(value * COARSE).try_cast("long")


def _fine(value: Column) -> Column:
    """What is left of the value; a whole number if it can be held."""
    return (value - _coarse(value).cast("double") / COARSE) * FINE


def inexact(*columns: str) -> Column:
    """Whether one of the values cannot be held."""
    found = F.lit(False)
    for name in columns or ("fCurrent", "fVoltage"):
        fine = _fine(F.col(name))
        # Comparisons with what is no number are null or false.
        whole = (fine == F.rint(fine)) & (F.abs(F.col(name)) < LIMIT)
        found = found | ~F.coalesce(whole, F.lit(False))
    return found


def minute_partials(readings: DataFrame) -> DataFrame:
    """One row per machine and minute that has readings."""
    sums = []
    for name in _SUMMED:
        value = F.col(f"f{name}")
        exact = ~inexact(f"f{name}")
        for alias, part in ((f"dCoarse{name}", _coarse(value)), (f"dFine{name}", _fine(value).try_cast("long"))):
            held = F.coalesce(F.when(exact, part), F.lit(0)).cast("decimal(20,0)")
            sums.append(F.sum(held).cast(SUM).alias(alias))
    ends = [f(f"f{n}").alias(f"f{end}{n}") for n in _SUMMED for f, end in ((F.min, "Minimum"), (F.max, "Maximum"))]
    grouped = readings.withColumn("dtMinute", tiled_start(F.col("dtInsert"), 1)).groupBy("strMachineName", "dtMinute")
    return grouped.agg(
        F.min("nSourceId").alias("nFirstSourceId"),
        F.max("nSourceId").alias("nLastSourceId"),
        F.count("*").alias("nRecords"),
        *sums,
        F.sum("nTemperature").alias("nSumTemperature"),
        *ends,
        F.min("nTemperature").alias("nMinimumTemperature"),
        F.max("nTemperature").alias("nMaximumTemperature"),
        F.count_if(inexact()).alias("nInexact"),
    ).select(*PARTIALS.fieldNames())


def _merged() -> list[Column]:
    """Partial states of one key made one."""
    least = [F.min(c).alias(c) for c in PARTIALS.fieldNames() if c.startswith(("nFirst", "fMinimum", "nMinimum"))]
    most = [F.max(c).alias(c) for c in PARTIALS.fieldNames() if c.startswith(("nLast", "fMaximum", "nMaximum"))]
    counted = [F.sum(c).cast(PARTIALS[c].dataType).alias(c) for c in PARTIALS.fieldNames() if c.startswith(("dCoarse", "dFine", "nRecords", "nSum", "nInexact"))]
    return [*least, *most, *counted]


def summed_partials(partials: DataFrame) -> DataFrame:
    """One row per machine and minute, of any number of loads."""
    return partials.groupBy("strMachineName", "dtMinute").agg(*_merged()).select(*PARTIALS.fieldNames())


def window_metrics_of(partials: DataFrame, window_minutes: int = 2) -> DataFrame:
    """As ``windows.window_metrics`` over the readings, and ``nInexact``."""
    placed = cover_windows(partials.withColumnRenamed("dtMinute", "dtInsert"), window_minutes)
    merged = placed.groupBy(*WINDOW_KEY).agg(*_merged())
    averages = {
        f"fAverage{n}": (F.col(f"dCoarse{n}").cast("double") / COARSE + F.col(f"dFine{n}").cast("double") / FINE) / F.col("nRecords")
        for n in _SUMMED
    }
    averages["fAverageTemperature"] = F.col("nSumTemperature") / F.col("nRecords")
    sums = [c for c in PARTIALS.fieldNames() if c.startswith(("dCoarse", "dFine", "nSum"))]
    found = merged.withColumns(averages).drop(*sums)
    end = F.col("dtWindowStart") + minutes(window_minutes)
    return found.withColumns({"dtWindowEnd": end, "nRecords": F.col("nRecords").cast("int")})


def merge_windows(partials: DataFrame, affected: DataFrame, window_minutes: int = 2) -> DataFrame:
    """As ``windows.recompute_windows``, from partial states, and ``nInexact``."""
    return window_metrics_of(partials, window_minutes).join(affected.select(*WINDOW_KEY), WINDOW_KEY)
