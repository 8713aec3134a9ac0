"""Order-free comparison of a Spark result with DuckDB SQL on the same tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


# DuckDB type by Spark type, for a schema check beside the values.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(df, con, sql: str) -> str | None:
    """None when names, types and the bag of rows agree; else what differs."""
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    expected_rows = cursor.fetchall()
    have = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if have != described:
        wrong = {n: (have.get(n), described.get(n)) for n in {*have, *described} if have.get(n) != described.get(n)}
        return f"schema (ours, oracle): {wrong}"
    names = sorted(have)
    at = [list(described).index(n) for n in names]
    expected = Counter(tuple(row[i] for i in at) for row in expected_rows)
    found = Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{found.total()} rows, expected {expected.total()}; {names}\n"
        f"  only ours:   {list(extra)[:2]}\n  only oracle: {list(missing)[:2]}"
    )
