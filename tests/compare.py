"""Compare a registered query with its SQL, as multisets of rows under sorted column names."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "INTEGER": "int"}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns, types and rows, else what differs."""
    kinds = {row[0]: _KINDS.get(row[1], row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    if kinds != dict(df.dtypes):
        return f"columns: {dict(df.dtypes)} but SQL has {kinds}"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    actual = _rows(df.columns, df.collect())
    if actual == expected:
        return None
    return (
        f"rows: {sum(actual.values())} and {sum(expected.values())} in SQL; "
        f"only here {list((actual - expected).items())[:3]}; only in SQL {list((expected - actual).items())[:3]}"
    )
