"""Run a named query and its SQL oracle over the same folder and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{os.path.join(sf_dir, name)}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(table, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())
