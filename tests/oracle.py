"""Comparing a query's rows with those of its SQL counterpart."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(cell(r[i]) for i in order) for r in records), key=repr)


KINDS = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "bigint", "hugeint": "hugeint",
    "double": "double", "float": "float", "varchar": "string", "string": "string", "boolean": "boolean",
}


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """(rows, differences) of a DataFrame and a SQL text."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, (KINDS.get(str(t).lower(), str(t).lower()) for t in rel.types)))
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    problems = []
    if ours != theirs:
        problems.append(f"schema {ours} / {theirs}")
    c1, r1 = rows_of(df.columns, [tuple(r) for r in df.collect()])
    c2, r2 = rows_of(rel.columns, rel.fetchall())
    if c1 != c2:
        problems.append(f"columns {c1} / {c2}")
    if len(r1) != len(r2):
        problems.append(f"{len(r1)} / {len(r2)} rows")
    different = [(a, b) for a, b in zip(r1, r2) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}"[:900])
    return len(r1), problems
