"""Every registered query that SQL can express against its DuckDB SQL at the
smallest scale."""

import os

import duckdb
import pytest

from __spark_entry__ import SMALLEST, entry, oracle_sql, queries
from compare import rows
from workload import oracles
from workload import queries as registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALLEST}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    """Those of the training-data operators have one where SQL can express them."""
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    left = queries()[name](spark, SMALLEST).toPandas()
    right = duck.sql(oracle_sql()[name]).df()
    assert sorted(left.columns) == sorted(right.columns)
    assert rows(left) == rows(right)


def test_entry(spark):
    assert entry(spark).columns == ["page_id", "text", "part", "categories"]
