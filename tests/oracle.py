"""Compares a query with its oracle on the same Parquet tables."""

import math
import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, query, sql):
    df = query(spark, SF)
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    mine, theirs = rows(df.columns, df.collect()), rows(names, got.fetchall())
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        for x, y in zip(a, b):
            assert x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-4 * max(1, abs(x)), (a, b)
