"""Side-by-side check of a Spark query against its DuckDB oracle.

Both results are normalised (columns sorted by name, decimals and floats to
text at a fixed precision, rows sorted) and compared row for row. Used by the
tests and for local verification; the query itself always runs on Spark.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from adlens.sources.testdata import TPCH_TABLES

ALL_TABLES = TPCH_TABLES + ["events", "documents", "embeddings", "pages", "benchmark",
                            "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    import os
    for t in ALL_TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def normalise(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple("" if x is None else x for x in t))
    return cols, out


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, sf_dir: str, df, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sc, sr = normalise(*spark_rows(df))
    dc, dr = normalise(*duck_rows(con, sql))
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "schema_match": sc == dc,
           "spark_cols": sc, "oracle_cols": dc}
    res["rows_match"] = sr == dr
    if not res["rows_match"]:
        s1, s2 = set(sr), set(dr)
        res["only_spark"] = sorted(s1 - s2, key=str)[:5]
        res["only_oracle"] = sorted(s2 - s1, key=str)[:5]
    return res
