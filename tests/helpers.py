import math
import os
from glob import glob

import duckdb

SMALL = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}") + 0.0
    if type(x).__name__ == "Decimal":
        return float(f"{x:.9g}")
    return tuple(map(plain, x)) if isinstance(x, list | tuple) else x


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def duck(sf_dir):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def same(df, sql, sf_dir):
    q = duck(sf_dir).execute(sql)
    columns = [d[0] for d in q.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.collect(), df.columns) == rows_of(q.fetchall(), columns)
