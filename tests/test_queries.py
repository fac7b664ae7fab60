"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, database

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQLS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQLS:
        assert compare(df, con, SQLS[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def test_every_twin_belongs_to_a_query():
    assert set(SQLS) <= set(QUERIES)
