"""Compares a query's rows with those of its SQL in DuckDB."""

import datetime
import math
import os

import duckdb
import numpy as np

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    """A value in a form that is the same from both engines."""
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.number)) or type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()[:26].replace("T00:00:00", "")
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    found = [tuple(plain(r[k]) for k in order) for r in data]
    return sorted(found, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return sorted(names), rows(names, got.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, df.collect())
