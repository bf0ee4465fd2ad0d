"""Run a registered Spark query and its DuckDB oracle, compare like the checker.

Comparison: same row count, same column names (compared sorted), and the same
multiset of rows after sorting columns by name. Doubles are compared after
rounding to 6 decimals (both engines sum in their own order).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not res["columns_match"]:
        res["spark_cols"] = sorted(s_cols)
        res["oracle_cols"] = sorted(d_cols)
        res["match"] = False
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb, key=str)[:5]
        res["only_oracle"] = sorted(sb - sa, key=str)[:5]
        res["cols"] = sorted(s_cols)
    return res
