"""Compare a Spark result with the checking SQL, regardless of row and column order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from placewell.registry.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty if the columns, their types and all values agree."""
    result = con.execute(sql)
    expected = {d[0]: str(d[1]) for d in result.description}
    ours_types = {name: TYPES.get(t, t) for name, t in df.dtypes}
    if ours_types != expected:
        return [f"columns: {sorted(ours_types.items() ^ expected.items())}"]
    theirs = _bag(list(expected), result.fetchall())
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    if ours == theirs:
        return []
    found = [f"rows: {sum(ours.values())} against {sum(theirs.values())}"]
    found += [f"only Spark: {r}" for r in list(ours - theirs)[:3]]
    found += [f"only SQL: {r}" for r in list(theirs - ours)[:3]]
    return found
