"""Side-by-side comparison of a Spark result with the DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(v) -> str:
    if v is None or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return f"dec:{v}"
    if isinstance(v, (dt.datetime, pd.Timestamp)):
        return v.isoformat(sep=" ")
    return str(v)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def compare(df, sql: str, con) -> list[str]:
    """Differences found; an empty list means the results agree."""
    problems = []
    rel = con.execute(sql)
    want_cols = [d[0] for d in rel.description]
    want_types = dict(zip(want_cols, [str(d[1]) for d in rel.description]))
    want, want_names = normal(rel.fetchall(), want_cols)
    got, got_names = normal([tuple(r) for r in df.collect()], df.columns)
    if got_names != want_names:
        return [f"columns spark-only={set(got_names) - set(want_names)} oracle-only={set(want_names) - set(got_names)}"]
    for name, kind in df.dtypes:
        expected = KINDS.get(kind, kind.upper())
        if want_types[name] not in (expected, "NULL") and not (expected, want_types[name]) == ("TIMESTAMP", "DATETIME"):
            problems.append(f"type {name}: spark {kind} oracle {want_types[name]}")
    if len(got) != len(want):
        problems.append(f"rows spark={len(got)} oracle={len(want)}")
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        if bad:
            diff = [(c, a, b) for c, a, b in zip(got_names, *bad[0]) if a != b]
            problems.append(f"{len(bad)} rows differ, first: {diff[:6]}")
    return problems
