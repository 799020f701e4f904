"""Registered queries that SQL can state, against their SQL, value by value."""

import duckdb
import pytest

from martkit.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def test_names():
    assert {int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")} == set(range(1, 14))
    assert "pipeline" in QUERIES and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("query", sorted(ORACLE))
def test_equal_to_oracle(spark, sf_dir, con, query):
    found = QUERIES[query](spark, sf_dir)
    cursor = con.execute(ORACLE[query])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    wanted = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in found.select(columns).collect()) == wanted
