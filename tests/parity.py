"""Runs a query and its SQL over the same tables and compares the rows, columns by name and order aside."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(value, v))
    return v


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(value(r[i]) for i in at) for r in data), key=repr)


def views(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def assert_equal(spark, con, folder, query, sql):
    df = query(spark, folder)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    theirs = rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(mine) == len(theirs)
    assert mine == theirs, [x for x in mine if x not in set(theirs)][:3]
