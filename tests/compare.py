"""Row-for-row comparison of a Spark frame with a DuckDB result."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def normalised(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(frame, sql: str, con) -> str | None:
    """None when names, row count and values agree; otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = normalised(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    found = normalised(frame.columns, frame.collect())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; "
        f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    )
