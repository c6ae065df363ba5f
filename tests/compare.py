"""Compare a registered query with its SQL on DuckDB, value by value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
    "binary": "BLOB", "array<bigint>": "BIGINT[]",
}


def differences(df, con, sql: str) -> list[str]:
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    expected = rows_of(names, relation.fetchall())
    types = dict(zip(names, [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]))
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    for name, kind in df.dtypes:
        if name in types and KINDS.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} vs {types[name]}")
    if not expected:
        problems.append("no rows expected")
    missing, extra = expected - found, found - expected
    if missing or extra:
        problems.append(
            f"{sum(expected.values())} expected, {sum(found.values())} found, {sum(missing.values())} missing, {sum(extra.values())} extra\n"
            f"   missing {list(missing)[:2]}\n   extra   {list(extra)[:2]}"
        )
    return problems
