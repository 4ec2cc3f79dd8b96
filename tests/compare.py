"""Order-free comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    plain = [tuple(_plain(t[i]) for i in order) for t in tuples]
    return names, sorted(plain, key=repr)


def from_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def from_duckdb(con, sql):
    cursor = con.execute(sql)
    return rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(got, want, most=3):
    """Empty text when equal, else the first differences."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return ""
    left, right = set(map(repr, got[1])), set(map(repr, want[1]))
    return "\n".join(
        [f"{len(got[1])} rows, expected {len(want[1])}"]
        + [f"  only spark: {r}" for r in sorted(left - right)[:most]]
        + [f"  only sql:   {r}" for r in sorted(right - left)[:most]]
    )
