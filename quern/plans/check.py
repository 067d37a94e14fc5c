"""Compares a query with its SQL on the same parquet files."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return str(int(v)) if v.is_integer() and abs(v) < 2**53 else repr(v)
    return str(v)


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None if both sides hold the same rows, else what differs."""
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    expected, got = _bag(columns, answer.fetchall()), _bag(df.columns, df.collect())
    if expected == got:
        return None
    extra, missing = list((got - expected).items()), list((expected - got).items())
    return f"{sum(got.values())} rows against {sum(expected.values())}; only in Spark {extra[:3]}; only in SQL {missing[:3]}"
