"""Compare a Spark query with its DuckDB oracle: row count, column names, values.

Values are compared as a multiset of rows with columns sorted by name, after
normalising each value to text (dates ISO, decimals as plain strings).
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"create view {v} as select * from read_parquet('{sf_dir.rstrip('/')}/{v}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def _rows(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = df.collect()
    cur = con.execute(sql)
    o_cols = [c[0] for c in cur.description]
    o_rows = cur.fetchall()
    res = {
        "query": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
    }
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    res["values_match"] = res["columns_match"] and a == b
    if not res["values_match"]:
        res["spark_columns"], res["oracle_columns"] = s_cols, o_cols
        res["only_spark"] = list((a - b).elements())[:3]
        res["only_oracle"] = list((b - a).elements())[:3]
    return res
