"""Row-by-row comparison of a Spark frame with a DuckDB result."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, df.collect())


def duckdb_rows(connection, sql: str):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return _sorted_rows(names, result.fetchall())


def pandas_kinds(frame):
    """Column kinds as pandas sees them, for comparing schemas across engines."""
    return {name: frame[name].dtype.kind for name in sorted(frame.columns)}
