"""Compare a query with its SQL in DuckDB: column names, types and all rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def difference(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    expected = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(expected.columns):
        return f"columns {names} against {sorted(expected.columns)}"
    ours = {name: _TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = dict(zip(expected.columns, map(str, expected.types)))
    if ours != theirs:
        return f"types {ours} against {theirs}"
    positions = [expected.columns.index(name) for name in names]
    want = Counter(tuple(row[p] for p in positions) for row in expected.fetchall())
    got = Counter(tuple(row[name] for name in names) for row in df.collect())
    if want != got:
        return (
            f"{got.total()} rows against {want.total()}; "
            f"only ours {list((got - want).items())[:3]}, only SQL {list((want - got).items())[:3]}"
        )
    return None
