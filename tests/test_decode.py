"""Messages good and bad."""

import pytest
from model import at
from pyspark.sql import functions as F

from fleetmetrics.operators.decode import (
    classify_messages,
    decode_messages,
    encode_messages,
    quarantine_messages,
)

HEAD = '{"strMachineName":"M1","fA":10.5,"fV":220,'
TAIL = '"nTemperature":84.5,"dtNow":"2024-01-01 10:00:00"}'
GOOD = HEAD + TAIL
INVALID, MISSING, CONSTRAINT = "invalid_json", "missing_field", "constraint"

CASES = [
    (GOOD, None, None),
    (f"  {GOOD}\t", None, None),
    (GOOD.replace("10.5", '"1.5"'), None, None),
    (GOOD.replace('"M1"', "5"), None, None),
    (GOOD.replace('"M1"', '"{x"'), None, None),
    (GOOD.replace('"M1"', '"a}]b"'), None, None),
    (GOOD.replace('"M1"', '"' + "M" * 100 + '"'), None, None),
    (GOOD[:-1] + ',"extra":[{"a":1}]}', None, None),
    (GOOD[:-1] + ',"fA":3}', None, None),
    ("not json", INVALID, None),
    ("[1, 2]", INVALID, None),
    ('"text"', INVALID, None),
    ("5", INVALID, None),
    ("null", INVALID, None),
    ("", INVALID, None),
    (None, INVALID, None),
    (GOOD + " tail", INVALID, None),
    (GOOD + GOOD, INVALID, None),
    (GOOD + "," + GOOD, INVALID, None),
    (GOOD + "] }", INVALID, None),
    (GOOD + ',"q":{}', INVALID, None),
    (GOOD[:-1], INVALID, None),
    (GOOD.replace('"', "'"), INVALID, None),
    (GOOD[:-1] + ",}", INVALID, None),
    ("{}", MISSING, "strMachineName"),
    (HEAD[:-1] + "}", MISSING, "nTemperature"),
    (GOOD.replace('"fV":220,', "").replace("10.5", "NaN"), MISSING, "fV"),
    (GOOD.replace('"fV":220,', "").replace("10.5", '"x"'), MISSING, "fV"),
    (GOOD.replace('"M1"', "null"), CONSTRAINT, "strMachineName"),
    (GOOD.replace('"M1"', '{"a":1}'), CONSTRAINT, "strMachineName"),
    (GOOD.replace('"M1"', '"' + "M" * 101 + '"'), CONSTRAINT, "strMachineName"),
    (GOOD.replace("10.5", "NaN"), CONSTRAINT, "fA"),
    (GOOD.replace("10.5", "Infinity"), CONSTRAINT, "fA"),
    (GOOD.replace("10.5", '"NaN"'), CONSTRAINT, "fA"),
    (GOOD.replace("10.5", "null"), CONSTRAINT, "fA"),
    (GOOD.replace("220", '"x"'), CONSTRAINT, "fV"),
    (GOOD.replace("84.5", "3e9"), CONSTRAINT, "nTemperature"),
    (GOOD.replace("2024-01-01", "2024-02-30"), CONSTRAINT, "dtInsert"),
    (GOOD.replace("2024-01-01 10:00:00", "soon"), CONSTRAINT, "dtInsert"),
]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "i int, value string")


def test_reasons(messages):
    found = {r.i: (r.reject_reason, r.reject_field) for r in classify_messages(messages).collect()}
    wrong = {CASES[i][0]: f for i, f in found.items() if f != CASES[i][1:]}
    assert len(found) == len(CASES) and not wrong


def test_accepted_and_rejected_make_the_whole(messages):
    good = {r.i for r in decode_messages(messages).select("i").collect()}
    bad = {r.i: r.value for r in quarantine_messages(messages).collect()}
    assert good == {i for i, c in enumerate(CASES) if c[1] is None}
    assert bad == {i: c[0] for i, c in enumerate(CASES) if c[1] is not None}


def test_values(messages):
    rows = {r.i: r for r in decode_messages(messages).collect()}
    first = rows[0]
    assert first.strMachineName == "M1" and (first.fA, first.fV) == (10.5, 220.0)
    assert first.nTemperature == 84.5 and first.dtInsert == at("10:00:00")
    assert rows[2].fA == 1.5 and rows[3].strMachineName == "5" and rows[8].fA == 3.0


def test_bytes_that_are_not_utf8_are_rejected(spark):
    rows = [(bytearray(GOOD, "utf-8"),), (bytearray(b'{"strMachineName":"\xff\xfe"}'),)]
    frame = spark.createDataFrame(rows, "value binary")
    reasons = [r.reject_reason for r in classify_messages(frame).collect()]
    assert reasons == [None, INVALID]


def test_encoding_comes_back_unchanged(messages):
    decoded = decode_messages(messages)
    again = decode_messages(encode_messages(decoded))
    assert sorted(map(str, again.drop("i").collect())) == sorted(
        map(str, decoded.drop("i").collect())
    )


def test_encoding_keeps_nulls_as_keys(spark):
    row = spark.createDataFrame(
        [(None, 1.0, 2.0, 3.0, at("10:00:00"))],
        "strMachineName string, fA double, fV double, nTemperature double, dtInsert timestamp_ntz",
    )
    text = encode_messages(row).select(F.col("value")).first()[0]
    assert text.startswith('{"strMachineName":null,"fA":1.0')
