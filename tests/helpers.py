"""Comparison of a query with its SQL, the way the driver does it."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import numpy as np
import pandas as pd


def plain(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (float, np.floating)):
        return None if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return v


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def from_spark(df):
    return by_name(df.columns, [tuple(r) for r in df.collect()])


def from_sql(sql, directory):
    con = duckdb.connect()
    for f in glob.glob(f"{directory}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    r = con.sql(sql)
    return by_name(r.columns, r.fetchall())
