"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    return value


def _family(value) -> str:
    return "int" if isinstance(value, int) and not isinstance(value, bool) else type(value).__name__


def differences(spark_rows: list, columns: list[str], oracle) -> list[str]:
    """Problems found: columns, row count, types or values (floats must agree to 1e-9)."""
    names = [d[0] for d in oracle.description]
    if sorted(names) != sorted(columns):
        return [f"columns {sorted(columns)} != {sorted(names)}"]
    order = sorted(columns)
    index = [names.index(c) for c in order]
    theirs = [tuple(_plain(row[i]) for i in index) for row in oracle.fetchall()]
    ours = [tuple(_plain(row[c]) for c in order) for row in spark_rows]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]

    def key(row):
        return tuple((v is None, type(v).__name__, f"{v:.6g}" if isinstance(v, float) else v) for v in row)

    problems = []
    for a, b in zip(sorted(ours, key=key), sorted(theirs, key=key)):
        for c, x, y in zip(order, a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12))
            if not same or _family(x) != _family(y):
                problems.append(f"{c}: {x!r} != {y!r} in {a} / {b}")
        if len(problems) > 4:
            break
    return problems
