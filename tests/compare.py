"""Run a registered query and its oracle and compare all rows."""

from __future__ import annotations

import datetime as dt
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, int, float, dt.datetime)):
        return v
    raise TypeError(f"value {v!r} of {type(v)} is not portable")


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted(names), _rows(names, cur.fetchall())


def differences(left, right, limit=3):
    """Human-readable differences between two (columns, rows) results; empty when equal."""
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return [f"columns only left {sorted(set(lc) - set(rc))}, only right {sorted(set(rc) - set(lc))}"]
    out = []
    if len(lr) != len(rr):
        out.append(f"rows {len(lr)} != {len(rr)}")
    for a, b in zip(lr, rr):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append("; ".join(f"{c}: {x!r} != {y!r}" for c, x, y in zip(lc, a, b) if x != y or type(x) is not type(y)))
            if len(out) >= limit:
                break
    return out
