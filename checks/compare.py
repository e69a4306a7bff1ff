"""Run a query and its SQL twin on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb
from pyspark.sql import SparkSession

from .registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _norm(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 6) + 0.0)
    if isinstance(x, (date, datetime)):
        return str(x)
    return str(x)


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, name: str, folder: str) -> str:
    """Empty text when equal, otherwise what differs."""
    df = QUERIES[name](spark, folder)
    ours_cols, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    theirs_cols, theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if ours_cols != theirs_cols:
        return f"columns {ours_cols} vs {theirs_cols}"
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        show = lambda c: [dict(zip(ours_cols, [v[:80] for v in r])) for r in list(c)[:2]]
        return (f"rows {sum(ours.values())} vs {sum(theirs.values())}; only ours {sum(extra.values())}: "
                f"{show(extra)}; only theirs {sum(lacking.values())}: {show(lacking)}")
    return ""
