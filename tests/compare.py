"""Order-free comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return str(value)
    return value


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=lambda r: [(c is None, str(c)) for c in r])


def sql_result(con, sql):
    cursor = con.execute(sql)
    return normalized([d[0] for d in cursor.description], cursor.fetchall())


def spark_result(df):
    return normalized(df.columns, [tuple(row) for row in df.collect()])
