"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from glob import glob
from pathlib import Path

import duckdb


def duck_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {Path(path).stem} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), _rows(names, cursor.fetchall())
