"""Every registered query against its SQL in DuckDB."""

import math
import re
from collections import Counter

import duckdb
import pytest
from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as entry

TABLES = ["events", "nation", "customer"]
# The queries of the training-data operators are tested with their package.
OWN = {name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)}
QUERIES = {k: q for k, q in entry.queries().items() if k in OWN}
ORACLES = {k: q for k, q in entry.oracle_sql().items() if k in OWN}


def plain(value):
    """Value with its type: 10 and 10.0 differ."""
    if isinstance(value, float) and math.isnan(value):
        value = "nan"
    return type(value).__name__, value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module", params=[SF_SMALL, SF_CHECK])
def database(request):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{request.param}/{table}.parquet'")
    yield request.param, con
    con.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, database, name):
    sf_dir, con = database
    result = QUERIES[name](spark, sf_dir)
    expected = con.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    want = rows_of(columns, expected.fetchall())
    got = rows_of(result.columns, result.collect())
    assert sum(got.values()) == sum(want.values())
    assert got == want
