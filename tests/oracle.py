"""Spark-vs-DuckDB comparison of one registered query (the driver's check, locally)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))
    return cols, out


def compare(spark, con, name, spark_df, sql):
    s_cols, s_rows = normalise(spark_df.columns, spark_df.collect())
    rel = con.execute(sql)
    d_cols, d_rows = normalise([d[0] for d in rel.description], rel.fetchall())
    diff = None
    if s_rows != d_rows:
        only_s = [r for r in s_rows if r not in set(d_rows)][:3]
        only_d = [r for r in d_rows if r not in set(s_rows)][:3]
        diff = {"only_spark": only_s, "only_duckdb": only_d}
    return {
        "name": name,
        "columns_match": s_cols == d_cols,
        "spark_columns": s_cols,
        "duckdb_columns": d_cols,
        "rows": (len(s_rows), len(d_rows)),
        "values_match": s_rows == d_rows,
        "diff": diff,
    }
