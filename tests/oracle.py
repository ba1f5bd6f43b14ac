"""Runs a registered query and its SQL and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([columns[i] for i in order]), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, sf_dir, query, sql) -> str:
    """Empty where both give the same columns and rows."""
    frame = query(spark, sf_dir)
    mine = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = connect(sf_dir).execute(sql)
    columns = [d[0] for d in result.description]
    theirs = _rows(columns, result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if mine[1] == theirs[1]:
        return ""
    only_mine = [r for r in mine[1] if r not in set(theirs[1])][:3]
    only_theirs = [r for r in theirs[1] if r not in set(mine[1])][:3]
    return f"{len(mine[1])} rows against {len(theirs[1])}; only in query: {only_mine}; only in SQL: {only_theirs}"
