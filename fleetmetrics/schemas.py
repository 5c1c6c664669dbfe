"""Table schemas. Timestamps carry no zone: they are site-local event times."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


READING_KEYS = ("strMachineName", "fA", "fV", "nTemperature", "dtNow")
MACHINE_NAME_LENGTH = 100

BUFFER = _struct(
    ("nId", T.LongType()),
    ("strMachineName", T.StringType()),
    ("fA", T.DoubleType()),
    ("fV", T.DoubleType()),
    ("nTemperature", T.DoubleType()),
    ("dtInsert", T.TimestampNTZType()),
)

RAW = _struct(
    ("nSourceId", T.LongType()),
    ("strMachineName", T.StringType()),
    ("fCurrent", T.DoubleType()),
    ("fVoltage", T.DoubleType()),
    ("nTemperature", T.IntegerType()),
    ("dtInsert", T.TimestampNTZType()),
    ("dtLoad", T.TimestampNTZType()),
)
RAW_KEY = ["nSourceId", "strMachineName"]

METRICS = _struct(
    ("nFirstSourceId", T.LongType()),
    ("nLastSourceId", T.LongType()),
    ("strMachineName", T.StringType()),
    ("dtWindowStart", T.TimestampNTZType()),
    ("dtWindowEnd", T.TimestampNTZType()),
    ("nRecords", T.IntegerType()),
    ("fAverageCurrent", T.DoubleType()),
    ("fMinimumCurrent", T.DoubleType()),
    ("fMaximumCurrent", T.DoubleType()),
    ("fAverageVoltage", T.DoubleType()),
    ("fMinimumVoltage", T.DoubleType()),
    ("fMaximumVoltage", T.DoubleType()),
    ("fAverageTemperature", T.DoubleType()),
    ("nMinimumTemperature", T.IntegerType()),
    ("nMaximumTemperature", T.IntegerType()),
    ("bTemperatureAlert", T.BooleanType()),
    ("dtProcessing", T.TimestampNTZType()),
)
METRICS_KEY = ["strMachineName", "dtWindowStart", "dtWindowEnd"]

CONTROL = _struct(
    ("strMachineName", T.StringType()),
    ("nLastProcessedSourceId", T.LongType()),
    ("dtLastProcessing", T.TimestampNTZType()),
)

QUARANTINE = _struct(
    ("value", T.StringType()),
    ("reject_reason", T.StringType()),
    ("reject_field", T.StringType()),
)
