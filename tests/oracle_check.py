"""Compares a query with its SQL: columns by name, rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> tuple[int, str | None]:
    """(rows, difference): the difference is None where the results agree."""
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(mine), f"columns {sorted(df.columns)} != {sorted(names)}"
    if any("HUGEINT" in k or "DECIMAL" in k for k in kinds.values()):
        return len(mine), f"wide SQL types {kinds}"
    if len(mine) != len(theirs):
        return len(mine), f"rows {len(mine)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return len(mine), (f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None)
