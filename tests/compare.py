"""Run a registered query and its SQL twin and compare rows, names and types."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0) if isinstance(value, float) else value
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _kind(value):
    return type(value).__name__ if value is not None else None


def compare(spark_df, relation) -> str | None:
    """None when equal, else what differs."""
    expected_names = [c[0] for c in relation.description]
    rows = relation.fetchall()
    names = sorted(spark_df.columns)
    if names != sorted(expected_names):
        return f"columns {names} != {sorted(expected_names)}"
    got = [[row[n] for n in names] for row in spark_df.collect()]
    places = [expected_names.index(n) for n in names]
    want = [[row[i] for i in places] for row in rows]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for i, name in enumerate(names):
        a = {_kind(r[i]) for r in got} - {None}
        b = {_kind(r[i]) for r in want} - {None}
        if a != b:
            return f"types of {name}: {a} != {b}"
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted(([_cell(v) for v in r] for r in got), key=key)
    want = sorted(([_cell(v) for v in r] for r in want), key=key)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first: {dict(zip(names, zip(*bad[0])))}" if bad else None
