"""Compare a query with its SQL twin, value by value."""

from __future__ import annotations

import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def _kind(v):
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, (float, Decimal)):
        return "float"
    return type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def kinds_of(columns, rows):
    return {c: {_kind(r[i]) for r in rows if r[i] is not None} for i, c in enumerate(columns)}


def compare(spark, con, name, query, sql, sf_dir):
    """Empty string if equal, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    g, gc = rows_of(df.columns, got)
    w, wc = rows_of(want_columns, want)
    if gc != wc:
        return f"columns {gc} against {wc}"
    if len(g) != len(w):
        return f"{len(g)} rows against {len(w)}"
    bad = [(a, b) for a, b in zip(g, w) if a != b]
    if bad:
        return f"{len(bad)} of {len(g)} rows differ, e.g. {bad[0]}"
    gk, wk = kinds_of(df.columns, got), kinds_of(want_columns, want)
    if gk != wk:
        return f"kinds {gk} against {wk}"
    return ""
