"""Run one registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, decimal.Decimal):
        return ("num", value.normalize() if value else decimal.Decimal(0))
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, types and values agree."""
    relation = con.sql(sql)
    expected_rows = relation.fetchall()
    found_columns, found = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    expected_columns, expected = normal(relation.columns, expected_rows)
    problems = []
    if found_columns != expected_columns:
        return [f"columns {found_columns} != {expected_columns}"]
    types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    for name, kind in spark_df.dtypes:
        want = KINDS.get(kind, kind.upper())
        if want.replace(" ", "") != types[name].replace(" ", ""):
            problems.append(f"type of {name}: {kind} != {types[name]}")
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    for a, b in zip(found, expected):
        if a != b:
            pairs = [(n, x, y) for n, x, y in zip(found_columns, a, b) if x != y]
            problems.append(f"first difference {pairs}; found row {a}; expected row {b}")
            break
    return problems
