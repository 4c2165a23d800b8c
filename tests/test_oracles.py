"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import duckdb
import pytest

from check_oracles import check
from tidemark.queries import ORACLES, QUERIES
from tidemark.queries.registry import TABLE_NAMES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    _, problem = check(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert problem is None
