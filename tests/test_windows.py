"""Window assignment and covering windows against their definitions."""

import random
from datetime import timedelta

import pytest
from model import at, start_of
from pyspark.sql import functions as F

from fleetmetrics.functions.clock import covering_windows, to_site_time, window_start
from fleetmetrics.functions.values import fixed, number_or_null, rounded_int, timestamp_or_null

LENGTHS = [1, 2, 5, 7, 11, 25, 45, 59, 60, 61, 90, 120, 150]


@pytest.fixture(scope="module")
def moments(spark):
    rng = random.Random(3)
    picked = [at("00:00:00") + timedelta(seconds=rng.randint(0, 400_000)) for _ in range(150)]
    picked += [at("10:59:59"), at("11:00:00"), at("00:00:00", 2), at("23:59:59")]
    picked.append(at("10:59:59") + timedelta(microseconds=999_999))
    return picked, spark.createDataFrame([(p,) for p in picked], "ts timestamp_ntz").cache()


@pytest.mark.parametrize("length", LENGTHS)
def test_windows_by_definition(moments, length):
    picked, frame = moments
    found = frame.select(
        "ts",
        window_start(F.col("ts"), length).alias("own"),
        covering_windows(F.col("ts"), length).alias("all"),
    )
    assert dict(found.dtypes)["own"] == "timestamp_ntz"
    for row in found.collect():
        assert row.own == start_of(row.ts, length)
        expected = set()
        for hours in range(0, length // 60 + 2):
            hour = row.ts.replace(minute=0, second=0, microsecond=0) - timedelta(hours=hours)
            for minute in range(0, 60, length):
                start = hour + timedelta(minutes=minute)
                if start <= row.ts < start + timedelta(minutes=length):
                    expected.add(start)
        assert len(row["all"]) == len(set(row["all"])) and set(row["all"]) == expected


def test_temperature_rounds_half_away_from_zero(spark):
    values = [84.49, 84.5, 85.5, -0.5, -1.5, 0.49999999999999994, 3e9, None]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r.n for r in frame.select(rounded_int(F.col("x")).alias("n")).collect()]
    assert found == [84, 85, 86, -1, -2, 0, None, None]


def test_text_coercions(spark):
    texts = ["1.5", " -2 ", "1e3", "1.5d", "NaN", "Infinity", "1e999", "x", "", "0x1F", None]
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    found = [r.n for r in frame.select(number_or_null(F.col("x")).alias("n")).collect()]
    assert found == [1.5, -2.0, 1000.0] + [None] * 8
    dates = ["2024-01-01 10:00:00", "2024-01-01T10:00:00", "2024-01-01", "2024-13-01", "2024", "x"]
    frame = spark.createDataFrame([(d,) for d in dates], "x string")
    found = [r.t for r in frame.select(timestamp_or_null(F.col("x")).alias("t")).collect()]
    assert found == [at("10:00:00"), at("10:00:00"), at("00:00:00"), None, None, None]


def test_display_numbers_round_like_c(spark):
    values = [2.675, 0.125, 1234567.891, -0.001, float("nan"), None]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r.t for r in frame.select(fixed(F.col("x"), "A").alias("t")).collect()]
    assert found == [f"{v:.2f} A" for v in values[:4]] + ["--", "--"]


def test_site_time_has_no_zone(spark):
    frame = spark.createDataFrame([(at("12:00:00"),)], "t timestamp_ntz")
    moved = frame.select(to_site_time(F.col("t"), "America/Sao_Paulo").alias("t"))
    assert moved.dtypes == [("t", "timestamp_ntz")] and moved.first().t == at("09:00:00")
