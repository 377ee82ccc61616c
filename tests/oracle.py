"""Compare a Spark result with what DuckDB returns for the query's SQL."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("num", round(v, 5) + 0.0)
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, Decimal)):
        return ("num", round(float(v), 5))
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
              "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences between a DataFrame and a query; empty if they agree."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    want = con.execute(sql).fetchall()
    got = [tuple(r) for r in df.collect()]
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns: spark {sorted(df.columns)} sql {sorted(names)}"]
    for name, kind in df.dtypes:
        if SPARK_TYPE.get(kinds[name], kinds[name]) != kind:
            out.append(f"type of {name}: spark {kind} sql {kinds[name]}")
    if len(got) != len(want):
        out.append(f"rows: spark {len(got)} sql {len(want)}")
    a, b = _rows(df.columns, got), _rows(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        cols = sorted(df.columns)
        x, y = bad[0]
        out.append(f"{len(bad)} rows differ, e.g. " + "; ".join(
            f"{c}: spark {p!r} sql {q!r}" for c, p, q in zip(cols, x, y) if p != q)[:600])
    return out
