"""Compare a registered query with its DuckDB counterpart, row for row."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return round(float(v), 6)
    return v


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description of what differs."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, res.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    return (
        f"rows spark={sum(got.values())} duckdb={sum(want.values())};"
        f" only spark: {list((got - want).items())[:3]}; only duckdb: {list((want - got).items())[:3]}"
    )
