"""Compare a query with the SQL it must equal: names, row count, values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    found = []
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sum(got.values()) != sum(expected.values()):
        found.append(f"{sum(got.values())} rows instead of {sum(expected.values())}")
    if got != expected:
        found.append(f"only Spark: {list((got - expected).items())[:3]}")
        found.append(f"only SQL: {list((expected - got).items())[:3]}")
    types = {type(v) for row in got for v in row} ^ {type(v) for row in expected for v in row}
    if types - {type(None)} and not found:
        found.append(f"types differ: {types}")
    return found
