"""Compare Spark rows with DuckDB rows, order aside."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (decimal.Decimal, datetime.datetime, bool)):
        return str(value)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), bag(df.columns, df.collect())


def duck_bag(db, sql):
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), bag(columns, result.fetchall())
