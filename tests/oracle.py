"""Rows of a query and of its SQL, made comparable."""

import math
import os

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def connect(folder):
    c = duckdb.connect()
    for name in os.listdir(folder):
        c.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{name}')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


def compare(df, connection, sql):
    """(rows of the query, rows of the SQL, columns whose types differ)."""
    columns = sorted(df.columns)
    found = connection.sql(sql)
    kinds = dict(zip(found.columns, map(str, found.types), strict=True))
    theirs = [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    other = sorted(tuple(plain(r.get(c, "absent")) for c in columns) for r in theirs)
    return mine, other, {c: (k, kinds.get(c)) for c, k in df.dtypes if TYPES.get(k, k) != kinds.get(c)}
