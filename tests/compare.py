"""Compare a Spark result with a DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return h, lines


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    o_cols = rel.columns
    o_rows = rel.fetchall()
    hs, ls = digest(s_rows, s_cols)
    ho, lo = digest(o_rows, o_cols)
    return {
        "rows": (len(s_rows), len(o_rows)),
        "cols_match": sorted(s_cols) == sorted(o_cols),
        "cols": (s_cols, o_cols),
        "hash_match": hs == ho,
        "diff": (sorted(set(ls) - set(lo))[:3], sorted(set(lo) - set(ls))[:3]),
    }
