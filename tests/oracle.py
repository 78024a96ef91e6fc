"""Rows of DuckDB over the driver's tables, and a comparison that ignores order and number types."""

import decimal
import math
import numbers

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str = "sf0.001", folder: str | None = None, tables: str = TABLES):
    con = duckdb.connect()
    for t in tables.split():
        con.execute(f"create view {t} as select * from read_parquet('{folder or f'{DATA}/{sf}'}/{t}.parquet{'/*.parquet' if folder else ''}')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (numbers.Number, decimal.Decimal)):
        return repr(round(float(v), 6))
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in data)


def same(df, con, sql):
    cursor = con.execute(sql)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in cursor.description], cursor.fetchall())
