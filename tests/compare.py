"""Run a registered query and its SQL on the same Parquet files and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value: object) -> object:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    rows = [tuple(r) for r in df.collect()]
    return sorted(df.columns), rows_of(df.columns, rows)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple], list[tuple[str, str]]]:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    types = sorted((d[0], str(d[1])) for d in got.description)
    return sorted(names), rows_of(names, got.fetchall()), types
