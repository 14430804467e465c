"""Compare a Spark result with DuckDB's on the same parquet tables, without regard to order."""

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "\0"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def spark_rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(_key(row[c]) for c in columns) for row in frame.collect())


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    places = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted(tuple(_key(row[i]) for i in places) for row in cursor.fetchall())
