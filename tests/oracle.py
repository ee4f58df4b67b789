"""Row-for-row comparison of a query with its SQL twin in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, list):
        return tuple(_cell(v) for v in value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Assert equal columns and rows; returns the row count."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(names, result.fetchall())
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    for a, b in zip(ours, theirs):
        assert a == b, (a, b)
    return len(ours)
