"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from tallybrook.plans.registry import ORACLES, QUERIES
from helpers import DATA
from oracle import actual, database, expected


@pytest.fixture(scope="module")
def con():
    return database(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    names, rows, _ = actual(QUERIES[name](spark, DATA))
    if name not in ORACLES:
        assert rows
    else:
        want_names, want, _ = expected(con, ORACLES[name])
        assert names == want_names
        assert rows == want


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
