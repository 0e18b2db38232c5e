"""Compare a query with its SQL, row by row, on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

KINDS = {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "double": "double", "string": "string",
         "boolean": "bool", "timestamp_ntz": "timestamp"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def differences(df, con, sql: str) -> list[str]:
    """What differs: column names and types, row counts, or rows (a few of each side)."""
    expected = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(expected.columns):
        return [f"columns {set(names) ^ set(expected.columns)}"]
    out = []
    kinds = {n: str(t).lower() for n, t in zip(expected.columns, expected.types)}
    same = {"integer": "int", "varchar": "string", "timestamp": "timestamp_ntz"}
    for n, t in df.dtypes:
        if same.get(kinds[n], kinds[n]) != t:
            out.append(f"type of {n}: {t} here, {kinds[n]} in SQL")
    at = [expected.columns.index(n) for n in names]
    want = Counter(tuple(plain(row[i]) for i in at) for row in expected.fetchall())
    got = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    if sum(want.values()) != sum(got.values()):
        out.append(f"rows: {sum(got.values())} here, {sum(want.values())} in SQL")
    for side, rest in (("only here", got - want), ("only in SQL", want - got)):
        out += [f"{side} ({sum(rest.values())}): {dict(zip(names, r))}" for r in sorted(rest, key=repr)[:2]]
    return out
