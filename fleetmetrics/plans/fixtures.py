"""Telemetry inputs derived from the ``events`` table.

All are plain projections of whole tables. The cadence readings follow the
five-machine, two-second rhythm with some late rows; the native readings keep
the sparse real timeline.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.operators.decode import encode_messages
from fleetmetrics.operators.windows import flag_alerts, window_metrics
from fleetmetrics.schemas import CONTROL, METRICS, RAW


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _number(sql: str) -> Column:
    return F.expr(sql).cast("double")


def cadence_buffer(source: DataFrame) -> DataFrame:
    """Readings as the buffer holds them: temperatures not yet rounded."""
    seconds = F.expr("2 * (event_id div 5) - if(event_id % 97 = 96, 300, 0)")
    return source.select(
        (F.col("event_id") + 1).alias("nId"),
        F.concat(F.lit("Machine"), F.expr("event_id % 5 + 1")).alias("strMachineName"),
        _number("8.0D + value % 6").alias("fA"),
        _number("216 + event_id % 9").alias("fV"),
        _number(
            "70.0D + (event_id % 5) * 3 + (event_id div 300) % 4 + (event_id % 4) * 0.25D"
        ).alias("nTemperature"),
        (
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
        ).alias("dtInsert"),
    )


def as_raw(buffer: DataFrame) -> DataFrame:
    load_delay = F.make_dt_interval(secs=(F.col("nId") % 60).cast("decimal(18,6)"))
    return buffer.select(
        F.col("nId").alias("nSourceId"),
        "strMachineName",
        F.col("fA").alias("fCurrent"),
        F.col("fV").alias("fVoltage"),
        F.round("nTemperature").cast("int").alias("nTemperature"),
        "dtInsert",
        (F.col("dtInsert") + load_delay).alias("dtLoad"),
    ).select(*RAW.fieldNames())


def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(cadence_buffer(events(spark, sf_dir)))


def native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30-day timeline; temperature is taken from the JSON properties."""
    source = events(spark, sf_dir).select(
        (F.col("event_id") + 1).alias("nId"),
        F.concat(F.lit("Machine"), F.expr("user_id % 5 + 1")).alias("strMachineName"),
        F.col("value").alias("fA"),
        _number("216 + event_id % 9").alias("fV"),
        F.get_json_object("props", "$.k").cast("double").alias("nTemperature"),
        F.col("ts").alias("dtInsert"),
    )
    return as_raw(source)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cadence readings on the wire; every 50th is broken, every 25th unusual."""
    text = encode_messages(cadence_buffer(events(spark, sf_dir)))
    return text.select("nId", _disturbed(F.col("nId") - 1, F.col("value")).alias("value"))


def message_stream(source: DataFrame) -> DataFrame:
    """The same texts from an events stream, without the id."""
    text = encode_messages(cadence_buffer(source))
    return text.select(_disturbed(F.col("nId") - 1, F.col("value")).alias("value"))


def _disturbed(event: Column, text: Column) -> Column:
    def edit(pattern: str, replacement: str) -> Column:
        return F.regexp_replace(text, pattern, replacement)

    open_end = F.substring(text, F.lit(1), F.length(text) - 1)
    broken = [
        F.concat(F.lit("reading "), event.cast("string")),
        F.concat(F.lit("["), event.cast("string"), F.lit(", 2]")),
        F.lit(""),
        F.concat(text, F.lit(" tail")),
        edit(r'"fV":[^,]*,', ""),
        edit(r'"strMachineName":"[^"]*"', '"strMachineName":null'),
        edit(r'"fA":[^,]*', '"fA":NaN'),
        edit(r'"fA":[^,]*', '"fA":"x"'),
        edit(r'"dtNow":"[^"]*"', '"dtNow":"2024-13-45 99:00:00"'),
        edit(r'"strMachineName":"', '"strMachineName":"' + "M" * 100),
    ]
    unusual = [
        edit(r'"fA":[^,]*', '"fA":"1.5"'),
        edit(r'"strMachineName":"[^"]*"', '"strMachineName":7'),
        F.concat(open_end, F.lit(',"site":"north"}')),
        F.concat(open_end, F.lit(',"fV":230.0}')),
    ]
    turn = F.expr("(nId - 1) div 50")

    def rotate(options: list[Column]) -> Column:
        picked = F.when(turn % len(options) == 0, options[0])
        for i, option in enumerate(options[1:], start=1):
            picked = picked.when(turn % len(options) == i, option)
        return picked

    return (
        F.when(event % 50 == 49, rotate(broken))
        .when(event % 50 == 24, rotate(unusual))
        .otherwise(text)
    )


def half_way(raw: DataFrame) -> int:
    return raw.agg(F.floor(F.max("nSourceId") / 2)).first()[0]


def latest_reading(raw: DataFrame) -> datetime:
    """``as_of`` of the queries: the newest event time, so some windows are open."""
    return raw.agg(F.max("dtInsert")).first()[0]


def half_way_control(raw: DataFrame) -> DataFrame:
    """Machines 1 to 4 half-way through the ids; Machine5 has no cursor yet."""
    known = raw.filter(F.col("strMachineName") != "Machine5")
    return known.groupBy("strMachineName").agg(
        F.lit(half_way(raw)).alias("nLastProcessedSourceId"),
        F.min("dtInsert").alias("dtLastProcessing"),
    ).select(*CONTROL.fieldNames())


def finished_metrics(raw: DataFrame, threshold: int = 85) -> DataFrame:
    """Metrics of every window of the readings, processed 75 s after its end."""
    metrics = flag_alerts(window_metrics(raw), threshold)
    processed = F.col("dtWindowEnd") + F.make_dt_interval(secs=F.lit(75))
    return metrics.withColumn("dtProcessing", processed).select(*METRICS.fieldNames())


def first_half_metrics(raw: DataFrame) -> DataFrame:
    return finished_metrics(raw.filter(F.col("nSourceId") <= half_way(raw)))
