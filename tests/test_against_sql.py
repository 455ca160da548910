"""Every registered query against its SQL in another engine, over the same files."""

import importlib

import compare
import pytest

from plateflow.plans import registry

entry = importlib.import_module("__spark_entry__")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data_dir):
    return compare.connect(data_dir)


def test_every_query_has_sql():
    assert not set(registry.QUERIES) - set(SQL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, data_dir, name):
    problem, _, _ = compare.difference(spark, con, data_dir, QUERIES[name], SQL.get(name))
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
