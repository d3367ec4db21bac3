"""Runs a query and its SQL on the same tables and compares the rows."""

import os

import duckdb


def views(sf):
    c = duckdb.connect()
    for f in sorted(os.listdir(sf)):
        path = os.path.join(sf, f)
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return c


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if isinstance(v, list | tuple):
        return tuple(map(norm, v))
    return v


def compare(spark, db, sf, query, sql):
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = db.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=repr)
    assert got == want
