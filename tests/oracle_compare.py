"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""
from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v))
    if isinstance(v, bool):
        return (1, str(v))
    return (1, str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort()
    return [cols[i] for i in order], out


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if len(sr) != len(dr):
        problems.append(f"row count spark={len(sr)} duck={len(dr)}")
    if not problems and sr != dr:
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        problems.append(f"values differ: spark-only={diff_s} duck-only={diff_d}")
    return problems, len(sr)
