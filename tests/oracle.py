"""Compares a query with its SQL on the same tables: names, types and rows, in any order."""

import os

import duckdb

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


def connected(folder):
    con = duckdb.connect()
    for name in sorted(os.listdir(folder)):
        path = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{path}'")
    return con


def _plain(x):
    return round(x, 6) + 0.0 if isinstance(x, float) else x


def compare(df, sql, con):
    result = con.execute(sql)
    names, kinds = [c[0] for c in result.description], [str(c[1]) for c in result.description]
    assert sorted(df.columns) == sorted(names)
    theirs = dict(zip(names, kinds, strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == theirs
    order = sorted(names)
    expected = sorted((tuple(_plain(r[names.index(c)]) for c in order) for r in result.fetchall()), key=repr)
    got = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == expected
