"""Compare a query with its SQL in DuckDB, as sorted rows."""

import datetime as dt
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return int(v) if v == int(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.date() if v.time() == dt.time(0) else v
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted([tuple(plain(r[k]) for k in order) for r in data], key=repr)


def differ(spark, query, sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}/*.parquet'" if os.path.isdir(p) else f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    df = query(spark, sf_dir)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    return rows(df.columns, df.collect()) != rows(names, found.fetchall())
