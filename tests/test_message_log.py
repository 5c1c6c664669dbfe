"""The message log: offsets, restart, unfinished lines, splits, lost segments."""

import os

import pytest

from fleetmetrics.sources import message_log as source
from fleetmetrics.streaming import streams

NOW = {"availableNow": True}
GOOD = '{"strMachineName":"M1","fA":%d,"fV":220,"nTemperature":80,"dtNow":"2024-01-01 10:00:00"}'


def add(folder, partition, segment, data):
    os.makedirs(f"{folder}/log/{partition}", exist_ok=True)
    with open(f"{folder}/log/{partition}/{segment}", "ab") as file:
        file.write(data)


def ranges(folder, split, start=None):
    log = source._Log({"path": f"{folder}/log", "splitBytes": str(split)})
    end = log.ends()
    found = [
        (r["partition"], r["segment"], r["position"], r["value"])
        for part in log.ranges(start or {}, end)
        for batch in log.messages(part)
        for r in batch.to_pylist()
    ]
    return found, end


@pytest.mark.parametrize("block", [3, 1 << 20])
@pytest.mark.parametrize("split", [1, 2, 5, 7, 1000])
def test_every_split_gives_each_message_once(folder, monkeypatch, split, block):
    monkeypatch.setattr(source, "BLOCK", block)
    lines = [b"", b"a", b"bcd" * 9, b"", "é\r".encode(), b"x y", b""]
    add(folder, "0", "1", b"\n".join(lines))  # a closed segment's last line needs no end
    add(folder, "0", "2", b"tail\nnot yet")
    add(folder, "1", "1", b"\n\n")
    starts = [sum(len(x) + 1 for x in lines[:i]) for i in range(len(lines))]
    wanted = [("0", "1", at, x) for at, x in zip(starts, lines, strict=True)][:-1]
    wanted += [("0", "2", 0, b"tail"), ("1", "1", 0, b""), ("1", "1", 1, b"")]
    found, end = ranges(folder, split)
    assert found == wanted
    assert end == {"0": ["2", 5], "1": ["1", 2]}
    add(folder, "0", "2", b" but now\n")
    add(folder, "2", "1", b"new\n")
    assert ranges(folder, split, end)[0] == [("0", "2", 5, b"not yet but now"), ("2", "1", 0, b"new")]
    assert ranges(folder, split, ranges(folder, split)[1])[0] == []


def test_lost_segments_are_reported(folder):
    add(folder, "0", "2", b"b\n")
    with pytest.raises(ValueError, match="gone"):
        ranges(folder, 10, {"0": ["1", 4]})


def test_no_log_and_empty_segments(folder):
    assert ranges(folder, 10) == ([], {})
    add(folder, "0", "1", b"")
    add(folder, "0", "_draft", b"x\n")
    assert ranges(folder, 10) == ([], {"0": ["1", 0]})


def test_a_stream_goes_on_in_the_middle_of_a_file(spark, store, folder):
    def run():
        messages = source.log_stream(spark, f"{folder}/log", split_bytes=50)
        streams.stream_readings(messages, store, f"{folder}/cp", trigger=NOW).awaitTermination()
        return sorted(r.fA for r in store.buffer().collect())

    line = (GOOD % 3).encode()
    add(folder, "0", "1", f"{GOOD % 1}\nbroken\n{GOOD % 2}\n".encode() + line[:20])
    assert run() == [1.0, 2.0]
    add(folder, "0", "1", line[20:] + b"\n")
    add(folder, "0", "2", f"{GOOD % 4}\n".encode())
    assert run() == [1.0, 2.0, 3.0, 4.0]
    assert store.quarantine().count() == 1


def test_appended_segments_are_read_again(spark, folder):
    rows = spark.range(100).selectExpr("cast(id as string) AS value").union(spark.createDataFrame([(None,)], "value string"))
    written = source.append_segment(rows, f"{folder}/log", 1)
    assert sum(r.messages for r in written.collect()) == 101
    found = [bytes(r.value).decode() for r in source.log_messages(spark, f"{folder}/log", 16).collect()]
    assert sorted(found) == sorted([*map(str, range(100)), ""])
