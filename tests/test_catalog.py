from __future__ import annotations

import pytest

import __spark_entry__ as entry
from larder import catalog
from tests import oracle


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, folder, name):
    ok, note = oracle.compare(spark, con, name, folder)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
