"""Stored facts by month and by order, monthly partials and what is read from them."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date

import pytest
from frames import market
from pyspark.sql import functions as F

from plateflow.operators import common, customers, delivery, executive, views
from plateflow.plans import partials, refresh
from plateflow.sources import store

TODAY = date(2000, 6, 1)
MONTHS = ("1999-11", "1999-12", "2000-01", "2000-02", "2000-05")


def rows_of(seed, n=160):
    """Orders over five months, some on either side of a word of the bitmap, with their deliveries and reviews."""
    rng = random.Random(seed)
    orders, trips, reviews = [], [], []
    for i in range(n):
        at = f"{rng.choice(MONTHS)}-{rng.randrange(1, 29):02d} {rng.randrange(24):02d}:15:00"
        status = rng.choice(["Delivered", "Delivered", "Delivered", "Cancelled", "Placed"])
        orders.append({"order_id": i, "customer_id": rng.randrange(25), "restaurant_id": rng.randrange(4), "zone_id": 11,
                       "order_timestamp": at, "order_status": status, "total_amount": rng.randrange(100, 900),
                       "platform_commission": rng.randrange(50), "discount_amount": rng.randrange(9)})
        if status == "Delivered" and i % 7:
            mins = rng.randrange(10, 70)
            trips.append({"delivery_id": i, "order_id": i, "partner_id": rng.randrange(5), "delivery_status": "Delivered",
                          "delivered_at": at, "actual_time_mins": None if i % 11 == 0 else mins, "expected_time_mins": 40,
                          "distance_km": rng.randrange(1, 9), "partner_earnings": rng.randrange(20, 60)})
            reviews.append({"review_id": i, "order_id": i, "restaurant_id": orders[-1]["restaurant_id"], "created_at": at,
                            "food_rating": rng.randrange(1, 6), "overall_rating": rng.choice([None, 1, 5])})
    return orders, trips, reviews


def marketplace(spark, orders, trips, reviews):
    return market(
        spark, orders=orders, deliveries=trips, reviews=reviews,
        cities=[{"city_id": 1, "city_name": "Here"}], zones=[{"zone_id": 11, "city_id": 1, "zone_name": "Z"}],
        restaurants=[{"restaurant_id": i, "restaurant_name": f"R{i}", "cuisine_type": "Any", "city_id": 1} for i in range(4)],
        customers=[{"customer_id": i, "customer_name": f"C{i}", "customer_tier": "Gold"} for i in range(25)],
        delivery_partners=[{"partner_id": i, "partner_name": f"P{i}", "city_id": 1, "zone_id": 11, "is_active": True} for i in range(5)])


TABLES = ("orders", "deliveries", "reviews", "cities", "zones", "restaurants", "customers", "delivery_partners")


def bag(df):
    return Counter(str(r) for r in df.collect())


CHECKS = {
    "daily_kpi": lambda m: views.daily_kpi(m), "restaurant_performance": lambda m: views.restaurant_performance(m),
    "hourly_demand": lambda m: views.hourly_demand(m), "partner_performance": lambda m: views.partner_performance(m),
    "customer_rfm": lambda m: views.customer_rfm(m, TODAY), "times": lambda m: delivery.delivery_times(m),
    "retention": lambda m: customers.cohort_retention(m), "matrix": lambda m: customers.cohort_matrix(m),
    "one_cohort": lambda m: customers.retention_report(m, year=1999, month=12),
}


def agrees(spark, folder, views_folder):
    plain = store.open_store(spark, folder, TABLES)
    kept = refresh.attach_views(store.open_store(spark, folder, TABLES), views_folder)
    assert {"delivery_minutes", "customer_months", *refresh.VIEWS} <= kept.stored.keys()
    for name, check in CHECKS.items():
        assert bag(check(kept)) == bag(check(plain)), name


def test_views_follow_the_months_that_changed(spark, tmp_path):
    folder, kept = f"{tmp_path}/store", f"{tmp_path}/views"
    orders, trips, reviews = rows_of(1)
    store.write_store(marketplace(spark, orders, trips, reviews), folder, TABLES)
    first = refresh.refresh(store.open_store(spark, folder, TABLES), TODAY, kept)
    agrees(spark, folder, kept)
    # Nothing changed: nothing is written.
    assert refresh.refresh(store.open_store(spark, folder, TABLES), TODAY, kept) == first
    # One month of orders loses rows, another one disappears; the other months' partials keep their files.
    found = partials.Partials(spark, f"{kept}/partials")
    untouched = [f for f in found.read("pairs").inputFiles() if "2000-01" in f or "1999-11" in f]
    left = [o for o in orders if o["order_timestamp"][:7] == "2000-02" and o["order_id"] % 2]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.write_orders(market(spark, orders=left).orders(), f"{folder}/orders")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    from plateflow.session import delete
    delete(spark, f"{folder}/orders/order_month=1999-12-01")
    changed = found.update(store.open_store(spark, folder, TABLES), folder)
    assert changed == {"orders": ["1999-12-01", "2000-02-01"], "reviews": [], "deliveries": []}
    second = refresh.refresh(store.open_store(spark, folder, TABLES), TODAY, kept)
    assert {n for n in first if first[n] != second[n]} == {"daily_kpi", "restaurant_performance", "hourly_demand", "customer_rfm"}
    assert set(untouched) <= set(found.read("pairs").inputFiles())
    agrees(spark, folder, kept)


def test_facts_are_pruned_by_month_and_joined_where_they_lie(spark, tmp_path):
    folder = f"{tmp_path}/store"
    orders, trips, reviews = rows_of(2)
    everything = marketplace(spark, orders, trips, reviews)
    store.write_store(everything, folder, TABLES, buckets=4)
    kept = store.open_store(spark, folder, TABLES)
    assert bag(kept.deliveries()) == bag(everything.deliveries()) and bag(kept.orders()) == bag(everything.orders())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pair = kept.orders("order_id", "order_date", since=date(2000, 1, 1)).join(
            kept.deliveries("order_id", "partner_id", since=date(2000, 1, 1)), "order_id")
        plan = pair._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("PartitionFilters: [isnotnull(order_month") == 2
        assert bag(pair) == bag(everything.orders("order_id", "order_date", since=date(2000, 1, 1)).join(
            everything.deliveries("order_id", "partner_id"), "order_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for query in (lambda m: delivery.zone_performance(m, TODAY, date(2000, 1, 1), date(2000, 2, 20)),
                  lambda m: executive.unit_economics(m, date(2000, 5, 28))):
        assert bag(query(kept)) == bag(query(everything))
        plan = query(kept)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "isnotnull(own_month" in executive.unit_economics(kept, date(2000, 5, 28))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("max_month", [0, 3, 12, 59])
def test_retention_by_bits(spark, max_month):
    """Customers whose months lie in one word, in two and in three."""
    rng = random.Random(max_month)
    active = {(c, rng.randrange(23_930, 24_080)) for c in range(40) for _ in range(rng.randrange(1, 12))} | {(99, 23_999), (99, 24_000)}
    bits = Counter()
    for customer, index in active:
        bits[customer, index // 60] |= 1 << index % 60
    words = [(c, sorted((w, b) for (d, w), b in bits.items() if d == c)) for c in {c for c, _ in bits}]
    got = common.cohorts_of(spark.createDataFrame(words, partials.WORDS), max_month)
    first = {c: min(i for d, i in active if d == c) for c, _ in active}
    want = Counter((date(first[c] // 12, first[c] % 12 + 1, 1), i - first[c]) for c, i in active if i - first[c] <= max_month)
    assert {(r.cohort, r.month_number): r.active_customers for r in got.collect()} == want
    assert all(r.cohort_size == want[r.cohort, 0] for r in got.collect())


def test_old_versions_of_a_view_go(spark, tmp_path):
    base = str(tmp_path / "v")
    for n in range(4):
        refresh.materialise(spark.range(n + 1), base, ["id"], ["id"], TODAY)
    assert len([p for p in (tmp_path / "v").iterdir() if p.name.startswith("v")]) == 2
    assert spark.read.parquet(f"{base}/{refresh._pointer(spark, base)['version']}").agg(F.count("*")).first()[0] == 4
