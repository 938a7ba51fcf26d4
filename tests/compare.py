"""Run a query in Spark and its SQL in DuckDB and compare rows as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree, otherwise what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wanted = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
    wanted |= {"boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}
    odd = [(c, k, kinds[c]) for c, k in df.dtypes if wanted.get(k) != kinds[c]]
    if odd:
        return f"types {odd}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if actual != expected:
        only_a, only_b = list((actual - expected).items())[:3], list((expected - actual).items())[:3]
        return f"{actual.total()} rows against {expected.total()}; only Spark {only_a}; only SQL {only_b}"
    return None
