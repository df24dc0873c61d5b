"""Compares registered queries with their SQL, cell by cell."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value + 0.0, 6)
    if hasattr(value, "toArray"):
        return tuple(value.toArray())
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def compare(spark, con, sf_dir: str, run, sql: str | None):
    """(problem or None, rows, seconds)."""
    start = time.time()
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    spent = time.time() - start
    if sql is None:
        return None, len(got), spent
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}", len(got), spent
    order = [columns.index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}", len(got), spent
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, e.g. spark {str(bad[0][0])[:300]} sql {str(bad[0][1])[:300]}", len(got), spent
    types = {n: type(w) for w in want for n, w in zip(names, w) if w is not None}
    mine = {n: type(g) for g in got for n, g in zip(names, g) if g is not None}
    return (f"types {mine} != {types}" if types != mine else None), len(got), spent
