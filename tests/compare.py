"""Run registered queries and their oracles on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in r) for r in df.select(*names).collect())


def rows_of_oracle(con, sql):
    result = con.execute(sql)
    cols = [d[0] for d in result.description]
    names = sorted(cols)
    pick = [cols.index(n) for n in names]
    return names, Counter(tuple(_plain(r[i]) for i in pick) for r in result.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both give the same rows, else what differs."""
    names, ours = rows_of_spark(df)
    other_names, theirs = rows_of_oracle(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if ours == theirs:
        return None
    only_ours, only_theirs = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"{ours.total()} rows != {theirs.total()} rows; only ours {only_ours}; only theirs {only_theirs}"
