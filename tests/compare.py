"""Compare a DataFrame with DuckDB's answer: names, kinds of type and rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _kinds(table) -> dict[str, str]:
    names = {}
    for field in table.schema:
        kind = str(field.type).replace("large_", "")
        names[field.name] = "timestamp" if kind.startswith("timestamp") else kind
    return names


def _rows(table, columns) -> Counter:
    return Counter(zip(*(table.column(c).to_pylist() for c in columns), strict=True))


def assert_same(df, con, sql: str) -> int:
    got, want = df.toArrow(), con.sql(sql).arrow()
    want = want.read_all() if hasattr(want, "read_all") else want
    assert sorted(got.column_names) == sorted(want.column_names)
    assert _kinds(got) == _kinds(want)
    columns = sorted(got.column_names)
    left, right = _rows(got, columns), _rows(want, columns)
    assert left == right, (list((left - right).items())[:3], list((right - left).items())[:3])
    return got.num_rows
