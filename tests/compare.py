"""Run a registered query and its reference SQL on the same tables and compare all values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(keyed, key=repr)


def compare(spark, name, fn, oracle, sf_dir):
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if oracle is None:
        return None if got else "no rows"
    result = connect(sf_dir).execute(oracle)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    want = rows_of(names, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, reference has {len(want)}; first {got[:1]} vs {want[:1]}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ; columns {sorted(names)}; first {wrong[0]}"
    return None
