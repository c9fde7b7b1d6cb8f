"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_points
from conftest import SMALLEST
from oracle import compare, connect

SQL = entry_points.oracle_sql()
# The corpus operators, where they are installed, have tests of their own.
QUERIES = {name: fn for name, fn in entry_points.queries().items() if not re.match(r"op\d+_|pipeline$", name)}


@pytest.fixture(scope="module")
def duck():
    return connect(str(SMALLEST))


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, str(SMALLEST)), duck, SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
