"""Runs a query and its SQL on the same tables and compares the rows."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(df, columns):
    return sorted((tuple(_plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)


def check(spark, sf_dir, con, query, sql):
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    theirs = sorted((tuple(_plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert rows(df, columns) == theirs
