"""Every registered query against its SQL on DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidelog.catalog.oracle import ORACLE
from tidelog.catalog.queries import QUERIES

from .check import compare, duck




@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, sf_dir, con, name):
    assert name in ORACLE
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_no_oracle_without_query():
    assert set(oracle_sql()) <= set(queries())
