"""Compare a query with its SQL, run by DuckDB over the same tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences found; an empty list means equal."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)} sql {sorted(names)}"]
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(names, expected)
    if got == want:
        kinds = {type(v) for r in got for v in r} - {type(None)}
        return [] if got else [f"no rows {kinds}"]
    return [
        f"rows: spark {sum(got.values())} sql {sum(want.values())}",
        f"only spark: {list((got - want).items())[:3]}",
        f"only sql: {list((want - got).items())[:3]}",
    ]
