"""Compare a Spark result with a DuckDB result as bags of rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def kind(name: str) -> str:
    name = name.lower()
    for spark_name, common in (
        ("string", "varchar"),
        ("int", "integer"),
        ("long", "bigint"),
        ("timestamp_ntz", "timestamp"),
    ):
        if name == spark_name:
            return common
    return name.replace(" ", "")


def spark_result(df):
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    return types, bag(df.columns, df.collect())


def duckdb_result(connection, sql):
    relation = connection.execute(sql)
    columns = [d[0] for d in relation.description]
    types = {d[0]: kind(str(d[1])) for d in relation.description}
    return types, bag(columns, relation.fetchall())
