"""Run a query and its SQL text side by side."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def differences(actual, expected) -> list[str]:
    """Names, types and exact values of two Arrow tables, row order aside."""
    if sorted(actual.column_names) != sorted(expected.column_names):
        return [f"columns {actual.column_names} and {expected.column_names}"]
    names = sorted(actual.column_names)
    out = []
    for name in names:
        types = [str(t.schema.field(name).type).replace("large_string", "string") for t in (actual, expected)]
        if types[0] != types[1]:
            out.append(f"{name}: {types[0]} and {types[1]}")
    sides = [sorted((tuple(_plain(r[n]) for n in names) for r in t.to_pylist()), key=repr) for t in (actual, expected)]
    if len(sides[0]) != len(sides[1]):
        out.append(f"{len(sides[0])} and {len(sides[1])} rows")
    different = [(a, b) for a, b in zip(*sides) if a != b]
    if different:
        out.append(f"{len(different)} rows differ, first {different[0]}")
    return out
