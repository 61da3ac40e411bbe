"""Every registered query against its SQL on the smallest tables, whole results compared."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracle import TABLES, compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    if name in contract.oracle_sql():
        result = duck.execute(contract.oracle_sql()[name])
        columns = [d[0] for d in result.description]
        assert compare(rows, df.columns, result.fetchall(), columns) == "ok"
    else:
        assert rows


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship_runs(spark):
    assert contract.entry(spark).columns
