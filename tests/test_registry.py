"""Every checked query against its SQL, and the driver's entry points."""

import importlib

import pytest
from conftest import DATA
from oracle import connect, difference

from tidemark.plans import registry


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(duck, registry.QUERIES[name](spark, DATA), registry.ORACLES[name]) is None


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    # Queries added from elsewhere may have no SQL; those of the registry all have.
    assert set(registry.QUERIES) <= entry.oracle_sql().keys() <= entry.queries().keys()
