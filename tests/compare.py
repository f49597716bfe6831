"""Run a registered query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in data]
    return [columns[i] for i in order], sorted(found, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result; empty if nothing does."""
    got_columns, got = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    want_columns, want = rows([d[0] for d in cursor.description], cursor.fetchall())
    problems = []
    if got_columns != want_columns:
        problems.append(f"columns {got_columns} / {want_columns}")
    if "HUGEINT" in types.values() or any(t.startswith("DECIMAL") for t in types.values()):
        problems.append(f"types {types}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} / {len(want)}")
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b]
        problems.append(f"{len(bad)} rows differ, first {bad[:2]}")
    return problems
