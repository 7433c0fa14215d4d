"""Run registered queries and their SQL twins on one folder and compare rows, names and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr([cell(r[i]) for i in order]) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    got = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want = bag([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            return f"value\n   spark {g}\n   sql   {w}"
    return None
