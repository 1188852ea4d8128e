"""Runs a query on Spark and its SQL on DuckDB and reports how the results differ."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree in columns, types, rows and values."""
    found = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in found.description}
    names, expected = _rows(list(kinds), found.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names} != {names}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if same.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None
