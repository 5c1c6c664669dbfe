"""Arrival ids, the ingest cursor, the incremental scan and the idempotent append."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.functions.clock import ntz
from fleetmetrics.functions.values import number_or_null, rounded_int, timestamp_or_null
from fleetmetrics.operators.decode import violated_column
from fleetmetrics.schemas import RAW, RAW_KEY

# One row per file goes to every executor; above this the plain join decides.
BROADCAST_FILES = 100_000


def assign_source_ids(stored: DataFrame, base: Column | int, id_column: str = "nId") -> DataFrame:
    """Number the rows of written Parquet files densely after ``base``.

    The id is the row's index in its file plus the rows of the files before it
    by the numbers in their names. It depends on the files alone: however they are split into
    tasks, and whichever task runs twice, a row gets the same id.
    ``stored`` has to be a read of the files, before any shuffle.
    """
    file = F.col("_metadata.file_path")
    sizes = stored.groupBy(file.alias("__file")).agg(F.count("*").alias("__rows"))
    number = F.regexp_extract("__file", r"/part-(\d+)[^/]*$", 1).try_cast("long")
    before = Window.orderBy(number, "__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    if len(stored.inputFiles()) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    start = base if isinstance(base, Column) else F.lit(base)
    source_id = (start + F.col("__offset") + F.col("__index") + 1).cast("long")
    return (
        stored.select("*", file.alias("__file"), F.col("_metadata.row_index").alias("__index"))
        .join(offsets, "__file")
        .select(source_id.alias(id_column), *stored.columns)
    )


def ingest_cursor(raw: DataFrame) -> DataFrame:
    """One row: the highest loaded source id, 0 for an empty table."""
    return raw.agg(F.coalesce(F.max("nSourceId"), F.lit(0)).alias("nLastSourceId"))


def incremental_scan(buffer: DataFrame, cursor: int) -> DataFrame:
    """Buffer rows strictly after the cursor, under the raw table's names."""
    return buffer.filter(F.col("nId") > cursor).select(
        F.col("nId").alias("nSourceId"),
        "strMachineName",
        F.col("fA").alias("fCurrent"),
        F.col("fV").alias("fVoltage"),
        "nTemperature",
        "dtInsert",
    )


def typed_readings(scanned: DataFrame) -> DataFrame:
    """Numbers and dates that a buffer holds as text, under the raw table's types.

    What cannot be converted becomes null, which the raw table refuses.
    """
    kinds = dict(scanned.dtypes)

    def typed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType):
            text = kinds[field.name] == "string"
            return timestamp_or_null(column) if text else column.cast("timestamp_ntz")
        if isinstance(field.dataType, (T.DoubleType, T.IntegerType)):
            number = number_or_null(column) if kinds[field.name] == "string" else column
            whole = isinstance(field.dataType, T.IntegerType)
            return rounded_int(number.cast("double")) if whole else number.cast("double")
        return column.cast(field.dataType)

    return scanned.select(*[typed(f).alias(f.name) for f in RAW.fields if f.name in kinds])


def load_readings(scanned: DataFrame, as_of: datetime) -> DataFrame:
    """Types as in the raw table, the temperature rounded, the load time stamped."""
    return typed_readings(scanned).withColumn("dtLoad", ntz(as_of)).select(*RAW.fieldNames())


def raw_violation() -> Column:
    """First column of a raw row that breaks its NOT NULL, length or type rule."""
    return violated_column({c: F.col(c) for c in RAW.fieldNames() if c != "dtLoad"})


def idempotent_append(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows to insert: one per (source id, machine), none already there."""
    return rows.dropDuplicates(RAW_KEY).join(existing.select(*RAW_KEY), RAW_KEY, "left_anti")
