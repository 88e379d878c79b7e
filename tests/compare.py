"""Side-by-side comparison of a Spark result and its SQL on the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(v)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    rel = con.sql(sql)
    want_cols, want = rel.columns, rel.fetchall()
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    if sorted(want_cols) != sorted(got_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = normal(got_cols, got), normal(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}; only spark {list(set(a) - set(b))[:3]}; only sql {list(set(b) - set(a))[:3]}"
    for x, y in zip(a, b):
        if x != y:
            return f"columns {sorted(got_cols)}: {x} != {y}"
        if [type(i) for i in x] != [type(i) for i in y]:
            return f"types {[type(i) for i in x]} != {[type(i) for i in y]}"
    return None
