"""Comparing a query with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

FAMILIES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def differences(frame, sql: str, connection: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs in columns, types, row count and values; empty when all agree."""
    expected = connection.sql(sql)
    types = dict(zip(expected.columns, map(str, expected.types)))
    mine = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    problems = []
    if set(types) != set(mine):
        return [f"columns {sorted(mine)} against {sorted(types)}"]
    for name, kind in mine.items():
        if FAMILIES.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} against {types[name]}")
    names = sorted(mine)
    order = [expected.columns.index(n) for n in names]
    theirs = sorted((tuple(_plain(row[i]) for i in order) for row in expected.fetchall()), key=repr)
    ours = sorted((tuple(_plain(row[n]) for n in names) for row in frame.collect()), key=repr)
    if len(ours) != len(theirs):
        problems.append(f"rows: {len(ours)} against {len(theirs)}")
    wrong = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    if wrong:
        problems.append(f"{len(wrong)} rows differ in {names}, first: {str(wrong[0])[:600]}")
    return problems
