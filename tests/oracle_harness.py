"""Run a catalogued Spark query and its DuckDB oracle on the same tables and
compare row count, column names/types and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT",
    "timestamp_ntz": "TIMESTAMP", "tinyint": "TINYINT",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return out


def compare(spark, name: str, spark_df, sql: str, con) -> dict:
    s_cols = spark_df.columns
    s_types = [f.dataType.simpleString() for f in spark_df.schema.fields]
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    s_t = dict(zip(s_cols, (SPARK_TO_DUCK.get(t, t) for t in s_types)))
    d_t = dict(zip(d_cols, d_types))
    res["type_mismatch"] = {c: (s_t[c], d_t.get(c)) for c in s_cols if s_t[c] != d_t.get(c)}
    if res["cols_match"]:
        a, b = _canon(s_rows, s_cols), _canon(d_rows, d_cols)
        res["hash_match"] = (hashlib.sha1(repr(a).encode()).hexdigest()
                             == hashlib.sha1(repr(b).encode()).hexdigest())
        if not res["hash_match"]:
            sa, sb = set(a), set(b)
            res["only_spark"] = list(sa - sb)[:5]
            res["only_oracle"] = list(sb - sa)[:5]
    else:
        res["hash_match"] = False
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    res["ok"] = (res["hash_match"] and res["spark_rows"] == res["oracle_rows"]
                 and not res["type_mismatch"])
    return res
