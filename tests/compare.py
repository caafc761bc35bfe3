"""Compare a registered query with its SQL oracle."""

from __future__ import annotations

import glob
import os
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry

SECONDS: dict[str, float] = {}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def plain(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, name: str, sf_dir: str) -> tuple[int, list[str]]:
    """Number of rows of the query, and what differs (empty if equal)."""
    started = time.time()
    frame = entry.queries()[name](spark, sf_dir)
    mine = rows_of(frame.columns, frame.collect())
    SECONDS[name] = time.time() - started
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        return sum(mine.values()), []
    cursor = connection.execute(oracle)
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(frame.columns):
        return sum(mine.values()), [f"columns {sorted(frame.columns)} != {sorted(columns)}"]
    theirs = rows_of(columns, cursor.fetchall())
    missing, extra = theirs - mine, mine - theirs
    out = [f"rows {sum(mine.values())} != {sum(theirs.values())}"] if missing or extra else []
    out += [f"missing {r}" for r in list(missing)[:3]] + [f"extra {r}" for r in list(extra)[:3]]
    return sum(mine.values()), out
