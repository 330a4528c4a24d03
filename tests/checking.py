"""Runs a query on Spark and its SQL on DuckDB and compares columns, types and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)) if v is None else v) for v in row)


def difference(df, db, sql: str) -> str | None:
    """None when both sides agree exactly, else what differs."""
    result = db.execute(sql)
    there = sorted((c[0], str(c[1])) for c in result.description)
    here = sorted((n, KINDS.get(t, t)) for n, t in df.dtypes)
    if [n for n, _ in here] != [n for n, _ in there]:
        return f"columns {here} vs {there}"
    names = [c[0] for c in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_sortable)
    got = sorted((tuple(r[n] for n in sorted(names)) for r in df.collect()), key=_sortable)
    types = {n: t for n, t in zip(names, (str(c[1]) for c in result.description))}
    wrong = [(n, t, types[n]) for n, t in here if types[n] != t and not (t == "VARCHAR" and types[n] == "STRING")
             and not (t == "BIGINT" and types[n] == "NUMBER")]
    if len(expected) != len(got):
        return f"{len(got)} rows vs {len(expected)}"
    for g, e in zip(got, expected):
        if not _same(g, e):
            return f"columns {sorted(names)}\n  spark {g}\n  sql   {e}"
    return f"types {wrong}" if wrong else None


def _same(a, b) -> bool:
    for x, y in zip(a, b):
        if x is None or y is None:
            if x is not y:
                return False
        elif isinstance(x, float) or isinstance(y, float):
            if not (x == y or (math.isnan(x) and math.isnan(y))):
                return False
        elif x != y:
            return False
    return True
