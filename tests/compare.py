"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


_FAMILY = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def mismatch(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, else the first difference."""
    relation = con.sql(sql)
    expected_types = {n: _FAMILY.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    actual_types = dict(df.dtypes)
    if expected_types != actual_types:
        return f"types: spark-only {set(actual_types.items()) - set(expected_types.items())}, sql-only {set(expected_types.items()) - set(actual_types.items())}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    expected = _rows(relation.columns, relation.fetchall())
    if len(actual) != len(expected):
        return f"rows: {len(actual)} != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"values: {a} != {e}"
    return None
