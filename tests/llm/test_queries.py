"""Queries with SQL against it; all of them over nothing but their own tables."""

import duckdb
import pytest

from visitgrid.llm.queries import QUERIES, SQL

from ..conftest import SMALL


def test_each_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    frame = QUERIES[name](spark, SMALL)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    got = sorted(repr([row[c] for c in columns]) for row in frame.collect())
    assert got and got == sorted(repr(list(row)) for row in result.fetchall())
