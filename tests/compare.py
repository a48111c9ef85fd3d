"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types of values and rows agree."""
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    expected = _rows(result.fetchall(), sql_columns)
    got = _rows([tuple(r) for r in spark_df.collect()], spark_df.columns)
    problems = []
    if sorted(sql_columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(sql_columns)}"]
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    for i, column in enumerate(sorted(sql_columns)):
        kinds = [{type(row[i]) for row in rows if row[i] is not None} for rows in (got, expected)]
        if kinds[0] != kinds[1] and all(kinds):
            problems.append(f"types of {column}: {kinds[0]} != {kinds[1]}")
    if got != expected:
        for a, b in zip(got, expected):
            if a != b:
                problems.append(f"first difference in {sorted(sql_columns)}: {a} != {b}")
                break
    return problems
