"""Compare a Spark result with the oracle's, value by value."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def type_difference(df, con, sql: str) -> str | None:
    wanted = {r[0]: r[1] for r in con.execute(f"DESCRIBE SELECT * FROM ({sql})").fetchall()}
    found = {c: TYPES.get(t, t) for c, t in df.dtypes}
    wrong = {c: (found[c], wanted[c]) for c in found if found[c] != wanted[c]}
    return f"types {wrong}" if wrong else None


def difference(df, con, sql: str) -> str | None:
    """None if columns and all rows agree exactly, else a short account."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    wanted = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    found = rows_of(df.columns, df.collect())
    if found == wanted:
        return type_difference(df, con, sql)
    only_found, only_wanted = found - wanted, wanted - found
    return (
        f"rows {sum(found.values())} vs {sum(wanted.values())}; "
        f"{sum(only_found.values())} only in Spark, e.g. {list(only_found)[:2]}; "
        f"{sum(only_wanted.values())} only in oracle, e.g. {list(only_wanted)[:2]}"
    )
