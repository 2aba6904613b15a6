"""Compare a Spark result with DuckDB on the same files."""

import math
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def differences(df, connection, sql, limit=3):
    """Empty when names and rows agree, else a description."""
    relation = connection.sql(sql)
    expected_names, expected = relation.columns, relation.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} against {sorted(expected_names)}"
    ours, theirs = rows_of(df.columns, got), rows_of(expected_names, expected)
    if ours == theirs:
        return ""
    left = [r for r in ours if r not in set(theirs)][:limit]
    right = [r for r in theirs if r not in set(ours)][:limit]
    return f"{len(ours)} rows against {len(theirs)}; only here {left}; only there {right}"
