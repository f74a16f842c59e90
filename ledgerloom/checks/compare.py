"""Row-by-row comparison of a registered query with its SQL. For checking small folders of tables only."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import SparkSession

from ledgerloom.checks.oracles import ORACLES, full_sql
from ledgerloom.checks.queries import QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder: str):
    """A DuckDB connection with the parquet tables as views."""
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if value is None or isinstance(value, (bool, Decimal, int)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _rows(rows, order) -> list[tuple]:
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, con, name: str, folder: str) -> tuple[int, list[str]]:
    """The number of rows of the query, and what differs from its SQL (nothing when they agree)."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    ours = _rows(df.select(*columns).collect(), range(len(columns)))
    if name not in ORACLES:
        return len(ours), []
    result = con.execute(full_sql(name))
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return len(ours), [f"columns {columns} <> {sorted(names)}"]
    theirs = _rows(result.fetchall(), [names.index(c) for c in columns])
    if ours == theirs:
        return len(ours), []
    found = [f"{len(ours)} rows <> {len(theirs)} rows"]
    found += [f"{dict(zip(columns, a))} <> {dict(zip(columns, b))}" for a, b in zip(ours, theirs) if a != b][:3]
    return len(ours), found
