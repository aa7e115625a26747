"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in records]
    return sorted(plain, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), rows(columns, cur.fetchall())


def frame_rows(df):
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


