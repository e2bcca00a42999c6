"""Side-by-side comparison of a registered query with its SQL oracle."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def compare(frame, con, sql):
    """Empty string when both sides agree, otherwise what differs."""
    spark_cols, spark_rows = rows_of(frame.columns, frame.collect())
    result = con.execute(sql)
    duck_cols, duck_rows = rows_of([d[0] for d in result.description], result.fetchall())
    if spark_cols != duck_cols:
        return f"columns {spark_cols} != {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)}"
    for ours, theirs in zip(spark_rows, duck_rows):
        if repr(ours) != repr(theirs):
            return f"\n  spark {ours}\n  duck  {theirs}"
    return "" if spark_rows else "both sides are empty"
