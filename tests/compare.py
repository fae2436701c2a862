"""Compare a query with its SQL in DuckDB, by value and as a multiset of rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def difference(df, con, sql: str) -> str:
    """Empty if equal; otherwise what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    want = rows(names, cursor.fetchall())
    got = rows(df.columns, [tuple(r.values()) for r in df.toArrow().to_pylist()])
    if want == got:
        return ""
    extra, lost = got - want, want - got
    return (f"{sum(got.values())} rows vs {sum(want.values())}; extra {list(extra.items())[:2]}; "
            f"missing {list(lost.items())[:2]}")
