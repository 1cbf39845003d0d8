"""Runs a registered query in Spark and its SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, run, sql, sf_dir) -> str | None:
    """None if both sides agree, else what differs."""
    found = run(spark, sf_dir)
    left = sorted_rows(found.columns, found.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    right = sorted_rows(columns, cursor.fetchall())
    if sorted(found.columns) != sorted(columns):
        return f"columns {sorted(found.columns)} != {sorted(columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ: {wrong[:2]}" if wrong else None
