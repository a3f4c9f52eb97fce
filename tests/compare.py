"""Runs a registered query and its SQL side by side and compares the rows."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(path)}')")
    return con


def _cell(value, digits):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value if digits is None else float(f"{value:.{digits}g}")
    if hasattr(value, "tolist"):
        return value.tolist()
    return value


def _rows(columns, rows, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(_cell(r[i], digits) for i in order) for r in rows]
    return sorted(made, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(df, con, sql: str, digits: int | None = None) -> list[str]:
    """Differences between a Spark result and the SQL result; empty when they agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(names):
        return [f"columns differ: {sorted(set(df.columns) ^ set(names))}"]
    if len(got) != len(expected):
        return [f"{len(got)} rows, expected {len(expected)}"]
    a, b = _rows(df.columns, got, digits), _rows(names, expected, digits)
    order = sorted(names)
    out = []
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            out += [f"{c}: {u!r} != {v!r}" for c, u, v in zip(order, x, y)
                    if u != v or type(u) is not type(v)][:3]
            if len(out) > 6:
                break
    return out
