"""Compare a registered query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "double": "float", "float": "float",
    "varchar": "text", "string": "text", "date": "date", "timestamp": "time", "timestamp_ntz": "time", "boolean": "bool",
    "hugeint": "hugeint",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def kind(name: str) -> str:
    name = name.lower()
    return FAMILY.get(name, name)


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


EMPTY = "no rows on either side, so nothing is shown"


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types, row count and values (exact, floats included)."""
    res = con.execute(sql)
    want_cols = [c[0] for c in res.description]
    want_types = {c[0]: kind(str(c[1])) for c in res.description}
    want = res.fetchall()
    got_cols, got_types = df.columns, {c: kind(t) for c, t in df.dtypes}
    problems = []
    if sorted(got_cols) != sorted(want_cols):
        return [f"columns {sorted(got_cols)} != {sorted(want_cols)}"]
    for c in got_cols:
        if got_types[c] != want_types[c]:
            problems.append(f"type of {c}: {dict(df.dtypes)[c]} against {want_types[c]}")
    got = [tuple(r) for r in df.collect()]
    a, b = normal(got_cols, got), normal(want_cols, want)
    if not a and not b:
        problems.append(EMPTY)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        problems.append(f"values differ in {len(left)}/{len(right)} rows; columns {sorted(got_cols)}; e.g. {sorted(left)[:2]} against {sorted(right)[:2]}")
    return problems
