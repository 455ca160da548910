"""Hand-built cases: gaps, ties, NULLs, zero denominators and fan-out."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from frames import dicts, market
from pyspark.sql import functions as F

from plateflow.operators import customers, delivery, executive, kpis, operations, questions, restaurants, views

AS_OF = date(2024, 3, 31)
CITIES = [{"city_id": 1, "city_name": "Here"}]
ZONES = [{"zone_id": 11, "city_id": 1, "zone_name": "Z", "avg_delivery_time_mins": 30}]
RESTS = [{"restaurant_id": i, "restaurant_name": f"R{i}", "cuisine_type": "Pizza", "city_id": 1, "zone_id": 11,
          "rating": 4, "is_active": True, "joining_date": "2024-01-01", "commission_rate": 20, "total_orders": 0}
         for i in (1, 2)]
PEOPLE = [{"customer_id": i, "customer_name": f"C{i}", "customer_tier": "Bronze", "city_id": 1, "is_active": True,
           "acquisition_channel": "Organic" if i < 3 else "Referral"} for i in (1, 2, 3)]


def order(i, customer, when, total, status="Delivered", **more):
    return {"order_id": i, "customer_id": customer, "restaurant_id": 1, "zone_id": 11, "order_timestamp": when,
            "order_status": status, "total_amount": total, "platform_commission": total / 5, "discount_amount": 0,
            **more}


@pytest.fixture(scope="module")
def small(spark):
    orders = [
        order(1, 1, "2024-01-05 12:00:00", 100), order(2, 1, "2024-03-20 12:00:00", 300),
        order(3, 1, "2024-03-20 12:00:00", 50, "Cancelled"), order(4, 2, "2024-01-07 23:30:00", 1000),
    ]
    tickets = [{"ticket_id": i, "customer_id": 1, "order_id": 2, "created_at": "2024-03-21 00:00:00"} for i in (1, 2)]
    reviews = [{"review_id": i, "order_id": 1, "restaurant_id": 1, "food_rating": r, "overall_rating": None}
               for i, r in ((1, 4), (2, 5))]
    trips = [
        {"delivery_id": 1, "order_id": 1, "partner_id": 7, "actual_time_mins": 45, "expected_time_mins": 45},
        {"delivery_id": 2, "order_id": 2, "partner_id": 7, "actual_time_mins": 46, "expected_time_mins": 45},
        {"delivery_id": 3, "order_id": 4, "partner_id": None, "actual_time_mins": None, "expected_time_mins": 30},
    ]
    for t in trips:
        t.update(delivery_status="Delivered", distance_km=2, partner_earnings=30)
    return market(spark, cities=CITIES, zones=ZONES, restaurants=RESTS, customers=PEOPLE, orders=orders,
                  support_tickets=tickets, reviews=reviews, deliveries=trips)


def test_sla_edges(small):
    got = {r["delivery_id"]: (r["sla_breached"], r["on_time"]) for r in dicts(small.deliveries())}
    assert got == {1: (False, True), 2: (True, False), 3: (None, None)}


def test_retention_skips_gap_months(small):
    rows = {(r["cohort"], r["month_number"]): (r["cohort_size"], r["active_customers"]) for r in dicts(
        customers.cohort_retention(small))}
    assert rows == {("2024-01", 0): (2, 2), ("2024-01", 2): (2, 1)}


def test_churn_counts_multiply_by_tickets(small):
    literal = {r["customer_id"]: r for r in dicts(customers.churn_risk(small, AS_OF))}
    fixed = {r["customer_id"]: r for r in dicts(customers.churn_risk(small, AS_OF, corrected=True))}
    # Three orders and two tickets make six joined rows.
    assert (literal[1]["total_orders"], literal[1]["support_tickets"], literal[1]["total_spent"]) == (3, 6, Decimal("900.00"))
    assert (literal[1]["orders_last_30d"], fixed[1]["orders_last_30d"]) == (4, 2)
    assert (fixed[1]["support_tickets"], fixed[1]["total_spent"]) == (2, Decimal("450.00"))
    # Nobody without orders is lost, and unknown recency counts as churned.
    assert literal[3]["churn_segment"] == "Churned" and literal[3]["cancellation_rate_pct"] is None


def test_channel_value_weighted_by_orders(small):
    literal = {r["acquisition_channel"]: r for r in dicts(customers.acquisition_channels(small))}
    fixed = {r["acquisition_channel"]: r for r in dicts(customers.acquisition_channels(small, corrected=True))}
    assert literal["Organic"]["avg_ltv"] == Decimal("600.00")   # (400 * 2 + 1000 * 1) / 3
    assert fixed["Organic"]["avg_ltv"] == Decimal("700.00")
    assert literal["Referral"]["activation_rate_pct"] == 0 and literal["Referral"]["avg_ltv"] is None


def test_health_fans_out_over_reviews(small):
    literal = {r["restaurant_id"]: r for r in dicts(restaurants.health_scores(small, AS_OF))}
    fixed = {r["restaurant_id"]: r for r in dicts(restaurants.health_scores(small, AS_OF, corrected=True))}
    # Four orders, one of them with two tickets, times two reviews.
    assert literal[1]["total_orders"] == 10 and fixed[1]["total_orders"] == 4
    assert literal[1]["support_tickets"] == 4 and fixed[1]["support_tickets"] == 2
    assert literal[1]["avg_food_rating"] == Decimal("4.50")
    assert literal[2]["cancellation_rate_pct"] is None


def test_growth_of_counts_is_truncated(small):
    rows = dicts(executive.new_and_returning(small))
    assert [r["new_customers"] for r in rows] == [0, 2]
    assert rows[0]["new_customer_growth_pct"] == -100
    assert dicts(executive.new_and_returning(small, corrected=True))[0]["new_customer_growth_pct"] == -100


def test_row_frames_ignore_missing_days(small):
    rows = {r["order_date"]: r["ma_7day"] for r in dicts(executive.moving_orders(small))}
    assert rows[date(2024, 3, 20)] == 1      # three rows, though months apart
    full = dicts(executive.moving_orders_calendar(small))
    assert len(full) == 76 and full[-1]["ma_days"] == Decimal("0.1")


def test_average_stays_null_until_the_window_is_full(small):
    assert all(r["ma7"] is None for r in dicts(executive.recent_trend(small, AS_OF)))


def test_empty_denominators(spark, small):
    empty = market(spark, cities=CITIES)
    assert dicts(executive.platform_overview(empty))[0]["gmv"] is None
    assert dicts(delivery.delivery_times(empty))[0]["sla_breach_pct"] is None
    assert dicts(executive.month_tiles(empty, AS_OF))[0]["take_rate_pct"] is None
    assert dicts(operations.order_funnel(empty))[0]["conversion_pct"] is None


def test_rfm_scores_recent_frequent_big(spark):
    orders, n = [], 0
    for c in range(1, 6):
        for k in range(c):
            n += 1
            orders.append(order(n, c, f"2024-03-{c * 5 - 4 + k % 2:02d} 10:00:00", 100 * c))
    people = [{"customer_id": c, "customer_name": f"C{c}", "customer_tier": "Gold", "city_id": 1} for c in range(1, 6)]
    rows = {r["customer_id"]: r for r in dicts(views.customer_rfm(market(spark, orders=orders, customers=people), AS_OF))}
    assert [rows[5][s] for s in ("r_score", "f_score", "m_score", "rfm_segment")] == [5, 5, 5, "Champions"]
    assert [rows[1][s] for s in ("r_score", "f_score", "m_score", "rfm_segment")] == [1, 1, 1, "Lost"]


@pytest.mark.parametrize("scores,published,dictionary", [
    ((5, 5, 5), "Champions", "Champions"), ((4, 4, 4), "Champions", "Champions"), ((3, 4, 5), "Loyal", "Loyal"),
    ((1, 5, 5), "At Risk", "At Risk"), ((1, 1, 1), "Lost", "Lost"), ((5, 1, 3), "Promising", "New Customer"),
    ((2, 2, 2), "Needs Attention", "Hibernating"), ((2, 3, 1), "Needs Attention", "Needs Attention"),
])
def test_segment_rules(spark, scores, published, dictionary):
    df = spark.createDataFrame([scores], "r_score int, f_score int, m_score int")
    got = df.select(views._segment(False).alias("a"), views._segment(True).alias("b")).first()
    assert (got["a"], got["b"]) == (published, dictionary)


def test_ramp_takes_the_day_of_the_nth_order(spark):
    orders = [order(i, 1, f"2024-01-{1 + i // 50:02d} 10:00:{i % 60:02d}", 10) for i in range(150)]
    m = market(spark, cities=CITIES, restaurants=RESTS, orders=orders)
    row = dicts(restaurants.onboarding_ramp(m))[0]
    assert (row["date_100th_order"], row["days_to_500_orders"], row["ramp_category"]) == (date(2024, 1, 2), None, "Fast Ramp")


def test_streak_breaks_at_a_gap(spark):
    days = [1, 2, 3, 5, 6]
    m = market(spark, restaurants=RESTS, orders=[order(d, 1, f"2024-01-{d:02d} 01:00:00", 10) for d in days])
    assert dicts(restaurants.longest_streaks(m))[0]["longest_streak_days"] == 3


def test_first_and_last_break_ties_by_number(small):
    row = [r for r in dicts(questions.first_and_last(small)) if r["customer_id"] == 1][0]
    assert row["total_orders"] == 2 and row["first_restaurant"] == "R1"


def test_revenue_breakdowns_add_up(small):
    total = dicts(kpis.revenue_metrics(small))[0]["gmv"]
    for by in kpis.BREAKDOWNS[:3]:
        assert sum(r["gmv"] for r in dicts(kpis.revenue_metrics(small, by=(by,))) if r["gmv"]) == total
    with pytest.raises(ValueError):
        kpis.revenue_metrics(small, by=("planet",))


def test_late_night_needs_the_fix(small):
    hours = lambda rows: {r["hour"]: r["time_period"] for r in rows}
    assert hours(dicts(operations.demand_plan(small)))[23] == "Off-Peak"
    assert hours(dicts(operations.demand_plan(small, late_night=True)))[23].startswith("Late Night")


def test_partner_average_keeps_idle_partners(spark, small):
    m = market(spark, delivery_partners=[{"partner_id": 7}, {"partner_id": 8}], deliveries=[
        {"delivery_id": 1, "partner_id": 7, "actual_time_mins": 45}, {"delivery_id": 2, "partner_id": 7, "actual_time_mins": 46}])
    assert {r["partner_id"]: r["avg_time"] for r in dicts(delivery.partner_average(m))} == {7: Decimal("45.500000"), 8: None}
    assert small.orders("order_id").filter(F.col("order_id") == 1).count() == 1
