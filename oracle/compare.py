"""Order-insensitive comparison of a Spark result with a DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=_key)


# Spark type -> the DuckDB type an oracle column must have.
SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_mismatches(spark_df, rel) -> dict:
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    bad_types = type_mismatches(spark_df, rel)
    if bad_types:
        return False, f"types differ (spark, duck): {bad_types}"
    d_rows = rel.fetchall()
    s_names, s_vals = normalized(s_cols, s_rows)
    d_names, d_vals = normalized(d_cols, d_rows)
    if s_names != d_names:
        return False, f"columns differ: spark={s_names} duck={d_names}"
    if len(s_vals) != len(d_vals):
        return False, f"row counts differ: spark={len(s_vals)} duck={len(d_vals)}"
    for a, b in zip(s_vals, d_vals):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(s_vals)} rows equal"
