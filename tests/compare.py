"""Compare registered queries with their oracle SQL, order-insensitively."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{decimal.Decimal(repr(value) if isinstance(value, float) else value):.6f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return str(value)


def table(rows, columns: list[str]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal; otherwise a short description of the difference."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(set(names) ^ set(spark_df.columns))}"
    got, want = table(spark_df.collect(), spark_df.columns), table(cursor.fetchall(), names)
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}; columns {sorted(names)}\n  spark  {only_got}\n  oracle {only_want}"
