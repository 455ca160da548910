"""Results come in the order the definitions state, also where names are joined last."""

from __future__ import annotations

import pytest

from plateflow.operators import customers, delivery, executive, operations, questions, restaurants
from plateflow.sources.star import AS_OF, star_market


@pytest.fixture(scope="module")
def m(spark, data_dir):
    return star_market(spark, data_dir)


# Operator, then the columns that order its rows; "-" for descending.
CASES = [
    (customers.lifetime_value, "-historical_ltv", "customer_id"), (customers.cohort_retention, "cohort", "month_number"),
    (delivery.late_orders, "-actual_time_mins", "order_id"), (delivery.zone_risk, "-sla_breach_pct"),
    (restaurants.top_items, "-times_ordered", "item_id"), (restaurants.cancellation_by_cuisine, "-cancel_rate_pct", "cuisine_type"),
    (operations.city_monthly_revenue, "city_name", "-month"), (operations.tickets_by_status, "issue_type", "-tickets"),
    (executive.monthly_growth, "-month"), (executive.moving_orders, "-order_date"),
    (questions.orders_by_hour, "-order_count", "hour"), (questions.above_own_average, "-above_avg_by", "order_id"),
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: c[0].__name__)
def test_order(m, case):
    query, *keys = case
    rows = query(m, AS_OF).collect()
    assert len(rows) > 1 or query is delivery.zone_risk

    def before(a, b):
        for key in keys:
            x, y = a[key.lstrip("-")], b[key.lstrip("-")]
            if x != y:
                return (x > y) == key.startswith("-")
        return True

    assert all(before(a, b) for a, b in zip(rows, rows[1:], strict=False))


def test_a_pivot_of_an_ordered_result_pays_no_sort(m):
    plan = customers.rfm_summary(m, AS_OF).groupBy().count()._jdf.queryExecution().optimizedPlan().toString()
    assert not plan.lstrip().startswith("Sort") and "Sort [avg_lifetime_spend" not in plan
