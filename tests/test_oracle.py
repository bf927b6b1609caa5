"""Every registered query at the smallest scale: SQL ones against DuckDB, the others must run."""

import duckdb
import pytest
from check import compare
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.tables import Tables

SQLS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in Tables.NAMES:
        connection.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, SMALL, name, queries()[name], SQLS.get(name))
    assert not verdict.startswith("BAD"), verdict


def test_entry(spark):
    assert entry(spark).count() > 0
