"""Every registered query against its SQL on the given tables."""

import math
from collections import Counter

import duckdb
import pytest

from visitgrid.catalog import load_catalog

from .conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
CATALOG = load_catalog()
SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_sql(spark, duck, name):
    item = CATALOG[name]
    frame = item.run(spark, SMALL)
    columns = sorted(frame.columns)
    got = Counter(tuple(comparable(row[c]) for c in columns) for row in frame.collect())
    assert item.sql, f"{name} has no SQL"
    result = duck.execute(item.sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {item.sql}").fetchall()}
    assert {c: SQL_TYPES[t] for c, t in frame.dtypes} == wanted
    order = [names.index(c) for c in columns]
    want = Counter(tuple(comparable(row[i]) for i in order) for row in duck.execute(item.sql).fetchall())
    assert got == want
    assert sum(got.values()) > 0
