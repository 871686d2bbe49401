"""Compares a query with its SQL on the same tables: columns by name, rows in any order, values as they are."""

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(root):
    connection = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(body, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def difference(frame, connection, sql):
    """None if both agree, else a short description."""
    cursor = connection.execute(sql)
    expected = table_of([c[0] for c in cursor.description], cursor.fetchall())
    actual = table_of(frame.columns, [tuple(r) for r in frame.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows instead of {len(expected[1])}: {actual[1][:3]} / {expected[1][:3]}"
    for mine, other in zip(actual[1], expected[1]):
        if mine != other:
            return f"row {mine} instead of {other}"
        kinds = [(type(a), type(b)) for a, b in zip(mine, other) if a is not None and type(a) is not type(b)]
        if kinds:
            return f"types {kinds} in {mine} and {other}"
    return None
