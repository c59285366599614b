"""Compare registered queries with their check SQL in DuckDB."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0 if v != 0 else 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """(equal, message) for a Spark result against DuckDB."""
    spark_cols, spark_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    duck_cols, duck_rows = [c[0] for c in cur.description], cur.fetchall()
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns {sorted(spark_cols)} vs {sorted(duck_cols)}"
    a, b = rows_of(spark_cols, spark_rows), rows_of(duck_cols, duck_rows)
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return (not bad), (f"{len(a)} rows" if not bad else f"{len(bad)} of {len(a)} differ, e.g. {bad[0]}")
