"""Runs registered queries next to their SQL and compares all values."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb

DATA = "/root/testdata"


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def from_spark(df):
    return df.columns, [tuple(row) for row in df.collect()]


def from_sql(con, sql):
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def kinds_of_spark(df):
    names = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    return {name: names.get(kind, kind) for name, kind in df.dtypes}


def kinds_of_sql(con, sql):
    return {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}


def difference(df, con, sql) -> str | None:
    """What differs first, or None."""
    spark_columns, spark_rows = from_spark(df)
    sql_columns, sql_rows = from_sql(con, sql)
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} / {sorted(sql_columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    for mine, other in zip(table(spark_columns, spark_rows), table(sql_columns, sql_rows)):
        if mine != other:
            return f"values {mine} / {other}"
    mine, other = kinds_of_spark(df), kinds_of_sql(con, sql)
    if mine != other:
        return f"types {sorted(set(mine.items()) ^ set(other.items()))}"
    return None
