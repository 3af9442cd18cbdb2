"""Spark result against the SQL equivalent: columns by name, rows as a multiset, floats to 9 digits."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from muara.plans.oracles import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree."""
    theirs = db.execute(sql)
    names = [c[0] for c in theirs.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} and {sorted(names)}"
    mine = rows_of(result.columns, result.collect())
    other = rows_of(names, theirs.fetchall())
    if mine == other:
        return ""
    return (
        f"{mine.total()} and {other.total()} rows; only Spark: {list((mine - other).items())[:3]};"
        f" only SQL: {list((other - mine).items())[:3]}"
    )
