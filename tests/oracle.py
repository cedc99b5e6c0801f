"""Runs a query's SQL on the same files and compares rows, whatever their order."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float, decimal.Decimal)):
        return f"{float(x):.6g}" if isinstance(x, float) else str(decimal.Decimal(x).normalize())
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def same(spark_df, con, sql: str) -> None:
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    want = found.fetchall()
    got = spark_df.collect()
    assert sorted(spark_df.columns) == sorted(columns)
    assert rows_of(spark_df.columns, got) == rows_of(columns, want)
