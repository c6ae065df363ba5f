"""Every registered query equals its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as entry
import catalog
from tests.compare import differences, oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
#: Queries that rightly find nothing in the smallest tables.
EMPTY = {"j03_single_files_to_send"}


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, con):
    problems = [p for p in differences(QUERIES[name](spark, SF), con, SQL[name]) if name not in EMPTY or p != "no rows expected"]
    assert not problems, "\n".join(problems)


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
