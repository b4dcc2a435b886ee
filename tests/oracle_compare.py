"""Run a Spark query and its DuckDB oracle on the same parquet tables and
compare row count, column names and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

from rivulet.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def canon(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], lines


def spark_rows(df):
    rows = df.collect()
    return list(df.columns), [tuple(r) for r in rows]


def duck_rows(con, sql):
    rel = con.sql(sql)
    return list(rel.columns), rel.fetchall()


def compare(df, con, sql) -> dict:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    scn, sl = canon(sc, sr)
    dcn, dl = canon(dc, dr)
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": scn == dcn,
           "hash_match": hashlib.sha256("\n".join(sl).encode()).hexdigest()
           == hashlib.sha256("\n".join(dl).encode()).hexdigest()}
    if not res["hash_match"]:
        sset, dset = set(sl), set(dl)
        res["only_spark"] = sorted(sset - dset)[:3]
        res["only_oracle"] = sorted(dset - sset)[:3]
        if not res["columns_match"]:
            res["spark_cols"], res["oracle_cols"] = scn, dcn
    return res
