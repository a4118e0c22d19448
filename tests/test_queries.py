"""Every registered query against its SQL, on the smallest sample tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from barlens.sample.oracle import ORACLE
from barlens.sample.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []
