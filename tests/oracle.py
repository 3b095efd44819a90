"""Run a query in Spark and its SQL in DuckDB and compare values exactly."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def kind(type_name: str) -> str:
    t = str(type_name).lower()
    for k, names in {
        "bigint": ("bigint", "int64"), "int": ("int", "integer", "int32"), "double": ("double", "float64"),
        "string": ("string", "varchar"), "bool": ("boolean", "bool"), "ts": ("timestamp", "timestamp_ntz"), "date": ("date",),
    }.items():
        if t in names:
            return k
    return t


def compare(spark_df, con, sql) -> str | None:
    """None if equal, else a short description of the first difference."""
    got_rows = spark_df.collect()
    res = con.sql(sql)
    types = dict(zip(res.columns, [kind(x) for x in res.types]))
    want_rows = res.fetchall()
    gc, got = table(spark_df.columns, got_rows)
    wc, want = table(res.columns, want_rows)
    if gc != wc:
        return f"columns {gc} != {wc}"
    for f in spark_df.schema.fields:
        k = kind(f.dataType.simpleString())
        if k != types[f.name]:
            return f"type of {f.name}: {k} != {types[f.name]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(gc, a, b) if x != y]
        return f"{len(bad)} of {len(got)} rows differ, e.g. {diff[:4]}"
    return None
