"""Round trips, revisits, and salvage of damaged archives."""

import base64
import gzip
import hashlib
import io
import random

import pyarrow as pa
import pytest
from llm import cases

from fleetmetrics.llm import warc
from fleetmetrics.session import scratch_folder

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/x y\r\n", "same"),
    (5, None, "same"),
    (5, "http://a", "same"),
    (2, "http://é/", "same"),
    (3, "http://b", None),
    (4, "http://b", ""),
    (6, "http://c", "unique é🙂 WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (None, "http://d", "same"),
    (None, "http://d", "only nulls"),
    (7, "http://e", "x" * 700_000),
    (8, "http://e", "\r\n\r\n"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    newest = {}
    for page, _, html in rows:
        body = html or ""
        if page is not None and len(body.encode()) >= least:
            newest[body] = max(newest.get(body, page), page)
    made = []
    for page, _, html in rows:
        body = html or ""
        top = newest.get(body)
        revisit = top is not None and page != top
        made.append((page, len(body.encode()), digest(body), "revisit" if revisit else "response", top if revisit else None))
    return sorted(made, key=repr)


def round_trip(spark, rows, **options):
    folder = scratch_folder(spark, "warc")
    pages = cases.with_clashes(cases.frame(spark, rows, SCHEMA))
    files = warc.write_warc(pages, folder, **options)
    return warc.read_warc(files, folder)


def test_round_trip(spark):
    read = round_trip(spark, ROWS, archive_bytes=2000)
    assert warc.gaps(read).collect() == []
    made = warc.records(read).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted([tuple(r[k] for k in keys) for r in made], key=repr) == expected(ROWS)
    payloads = {r.page_id: bytes(r.payload).decode() for r in made if r.record_type == "response"}
    assert payloads[6] == ROWS[6][2]
    assert len(payloads[7]) == 700_000


def test_small_payloads_can_be_left_out_of_revisits(spark):
    made = warc.records(round_trip(spark, ROWS, least=5)).collect()
    assert sorted([(r.page_id, r.record_type) for r in made], key=repr) == sorted([(e[0], e[3]) for e in expected(ROWS, 5)], key=repr)


def test_empty_table(spark):
    assert round_trip(spark, []).collect() == []


# -- salvage ------------------------------------------------------------------


class Memory:
    def __init__(self, data):
        self.file = pa.BufferReader(data)

    def size(self):
        return self.file.size()

    def read_at(self, length, offset):
        return self.file.read_at(length, offset)


def salvaged(data):
    rows = list(warc.salvage(warc.Source(Memory(data))))
    at = 0
    for offset, length, _, _ in rows:
        assert offset == at
        at += length
    assert at == len(data)
    return [r["page_id"] for _, _, gap, r in rows if gap is None], [(o, n) for o, n, gap, _ in rows if gap]


def parts(compressed, n=8, size=400):
    made = [warc.record(i, f"http://h/{i}", cases.prose(i, size).encode(), None if i % 3 else i + 100) for i in range(n)]
    return [gzip.compress(m, mtime=0) for m in made] if compressed else made


@pytest.mark.parametrize("compressed", [True, False])
def test_damage_loses_only_the_records_it_touches(compressed):
    pieces = parts(compressed)
    starts = [sum(map(len, pieces[:i])) for i in range(len(pieces))]
    data = b"".join(pieces)
    assert salvaged(data) == (list(range(8)), [])
    middle = starts[4] + len(pieces[4]) // 2
    broken = data[:middle] + bytes([data[middle] ^ 0xFF]) + data[middle + 1 :]
    assert salvaged(broken) == ([0, 1, 2, 3, 5, 6, 7], [(starts[4], len(pieces[4]))])
    assert salvaged(data[:-5]) == (list(range(7)), [(starts[7], len(pieces[7]) - 5)])
    junk = b"junk \x1f\x8b\x08 junk WARC/1.0\r\nContent-Length: 5\r\n\r\nxx"
    assert salvaged(junk + data) == (list(range(8)), [(0, len(junk))])
    cut = data[: starts[2] + 9] + data[starts[3] :]
    assert salvaged(cut) == ([0, 1, 3, 4, 5, 6, 7], [(starts[2], 9)])
    assert salvaged(b"") == ([], [])
    assert salvaged(b"x" * 10) == ([], [(0, 10)])


def test_plain_and_compressed_records_mix():
    pieces = [a if i % 2 else b for i, (a, b) in enumerate(zip(parts(True), parts(False), strict=True))]
    assert salvaged(b"".join(pieces)) == (list(range(8)), [])


@pytest.mark.parametrize("compressed", [True, False])
def test_candidates_across_a_step_are_found(monkeypatch, compressed):
    monkeypatch.setattr(warc, "STEP", 64)
    pieces = parts(compressed, n=5, size=60)
    data = b"\x00" * 61 + pieces[0] + b"\x01" * 59 + b"".join(pieces[1:])
    assert salvaged(data) == (list(range(5)), [(0, 61), (61 + len(pieces[0]), 59)])


def test_wrong_digest_is_damage():
    good = warc.record(1, "http://a", b"payload", None)
    assert salvaged(good.replace(b"payload\r\n", b"pAyload\r\n"))[0] == []


@pytest.mark.parametrize("seed", range(30))
def test_random_damage_never_breaks_the_reader(seed):
    chance = random.Random(seed)
    data = bytearray(b"".join(parts(seed % 2 == 0, n=5, size=50)))
    for _ in range(chance.randint(1, 6)):
        at = chance.randrange(len(data))
        chance.choice([lambda: data.__setitem__(at, chance.randrange(256)), lambda: data.__delitem__(slice(at, at + 3)), lambda: data.insert(at, 7)])()
    ids, _ = salvaged(bytes(data))
    # The header of a plain record has no digest: an id may be damaged unseen.
    assert seed % 2 or set(ids) <= set(range(5))


def test_members_are_readable_by_other_tools():
    data = b"".join(parts(True, n=3))
    assert gzip.GzipFile(fileobj=io.BytesIO(data)).read().count(b"WARC/1.1\r\n") == 3
