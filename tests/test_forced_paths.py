"""The paths meant for large or skewed data, forced on small data and compared with the same SQL."""

import importlib

import compare
import pytest

from plateflow.functions import skew

entry = importlib.import_module("__spark_entry__")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
NAMES = ("v3_restaurant_performance", "v6_customer_rfm", "re1_monthly_ranking", "i16_city_ranking", "i19_food_explorers",
         "i25_above_own_average", "i35_order_values", "i39_abc_items_all", "x5_refunds", "x7_assigned",
         "d11_illegal_transitions", "t3_audit_log")


@pytest.fixture(autouse=True)
def forced(monkeypatch):
    small = tuple(5 if d == skew.HOT_ROWS else d for d in skew.join_spread.__defaults__)
    monkeypatch.setattr(skew.join_spread, "__defaults__", small)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data_dir, name):
    problem, _, _ = compare.difference(spark, compare.connect(data_dir), data_dir, QUERIES[name], SQL[name])
    assert problem is None, problem
