"""Run a registered query and its SQL equivalent and compare the two results."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_columns, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            differing = [(c, x, y) for c, x, y in zip(got_columns, a, b) if x != y]
            return f"row differs: {differing[:4]}"
        if [type(x) for x in a] != [type(y) for y in b]:
            return f"types differ: {[(c, type(x), type(y)) for c, x, y in zip(got_columns, a, b) if type(x) is not type(y)]}"
    return None
