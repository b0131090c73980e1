"""Every registered query against SQL on the same tables."""

import importlib

import pytest
from compare import assert_same, duck

from catalogue.queries import QUERIES

entry = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert assert_same(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["window_end", "itemId", "view_count", "rank"]
    assert result.count() > 0
