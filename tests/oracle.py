"""Compare registered queries with their SQL, as bags of rows with columns sorted by name."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

from workloads.base import ORACLES, QUERIES, TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, folder)
    left = bag(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None
    found = con.execute(ORACLES[name])
    right = bag([d[0] for d in found.description], found.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if left[1] != right[1]:
        more, less = left[1] - right[1], right[1] - left[1]
        return (
            f"{sum(left[1].values())} rows against {sum(right[1].values())}; "
            f"only here {list(more)[:2]}; only there {list(less)[:2]}"
        )
    types = {"BIGINT": "bigint", "VARCHAR": "string", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}
    for d in found.description:
        want, have = types.get(str(d[1])), df.schema[d[0]].dataType.simpleString()
        if want and want != have:
            return f"{d[0]} is {have}, not {want}"
    return None
