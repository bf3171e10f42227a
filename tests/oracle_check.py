"""Runs catalogue queries next to their DuckDB counterparts and compares the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    rows = [tuple(row[i] for i in order) for row in records]
    return names, sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def compare(spark, con, sf_dir, build, sql):
    """An empty text if equal, else what differs."""
    df = build(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}; {ours[1][:2]} / {theirs[1][:2]}"
    different = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(different)} of {len(ours[1])} differ: {different[0]}" if different else ""
