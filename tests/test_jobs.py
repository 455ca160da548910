"""Request batches, validation, storage, reports and streams."""

from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

import pytest
from frames import dicts, frame, market
from pyspark.sql import functions as F

from plateflow.model import DELIVERY_MOVES, ORDER_MOVES, ORDER_STATUSES
from plateflow.operators import quality, requests
from plateflow.plans import refresh, runner
from plateflow.sources import csv_tables, seeds, store
from plateflow.streaming import maintain as keep

TODAY = date(2024, 6, 1)
MENU = [{"item_id": 1, "restaurant_id": 1, "price": 199, "is_available": True},
        {"item_id": 2, "restaurant_id": 1, "price": 89, "is_available": True},
        {"item_id": 3, "restaurant_id": 1, "price": 1000, "is_available": True},
        {"item_id": 4, "restaurant_id": 1, "price": 10, "is_available": False}]
REST = [{"restaurant_id": 1, "restaurant_name": "R", "cuisine_type": "Thai", "is_active": True, "zone_id": 11,
         "commission_rate": 20, "city_id": 1}, {"restaurant_id": 2, "is_active": False, "zone_id": 11}]
WHO = [{"customer_id": 1, "is_active": True}, {"customer_id": 2, "is_active": False}]
CART = '[{"item_id":1,"quantity":2},{"item_id":2,"quantity":1}]'


def promo(i, code, kind, value, **more):
    return {"promotion_id": i, "promo_code": code, "promo_type": kind, "discount_value": value, "min_order_amount": 199,
            "start_date": "2024-01-01", "end_date": "2024-12-31", "is_active": True, "current_uses": 0, **more}


PROMOS = [promo(1, "SAVE20", "PERCENT", 20, max_discount=80), promo(2, "FLAT50", "FLAT", 50), promo(3, "FREE", "FREE_DELIVERY", 40),
          promo(4, "TWOFORONE", "BOGO", 1), promo(5, "OLD", "FLAT", 50, end_date="2024-02-01"),
          promo(6, "FULL", "FLAT", 50, max_uses=10, current_uses=10), promo(7, "LAST", "FLAT", 75, max_uses=10, current_uses=9),
          promo(8, "BIG", "FLAT", 500, min_order_amount=0)]


def ask(spark, *rows):
    data = [(i + 1, r.get("customer", 1), r.get("restaurant", 1), 1, r.get("items", CART), r.get("promo"), "UPI", "App",
             f"2024-06-01 10:{i:02d}:00") for i, r in enumerate(rows)]
    names = "request_id long, customer_id long, restaurant_id long, address_id long, items string, promo_code string, " \
            "payment_method string, order_channel string, requested_at string"
    return spark.createDataFrame(data, names).withColumn("requested_at", F.col("requested_at").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def shop(spark):
    return market(spark, menu_items=MENU, restaurants=REST, customers=WHO, promotions=PROMOS)


def test_order_money(spark, shop):
    placed = requests.place_orders(shop, ask(spark, {"promo": "FLAT50"}), TODAY)
    row = dicts(placed.orders)[0]
    # 2 x 199 + 89 = 487; less 50; 5 % tax on 437; fee 39.
    assert (row["subtotal_amount"], row["taxes"], row["total_amount"]) == (Decimal("487.00"), Decimal("21.85"), Decimal("497.85"))
    assert row["platform_commission"] == Decimal("99.57")
    assert dicts(placed.payments)[0]["transaction_id"] == "TXN0000000001"
    assert {(r["item_id"], r["item_total"]) for r in dicts(placed.items)} == {(1, Decimal("398.00")), (2, Decimal("89.00"))}


def test_promotions(spark, shop):
    big = '[{"item_id":3,"quantity":1}]'
    cases = [{"promo": "SAVE20", "items": big}, {"promo": "FREE"}, {"promo": "TWOFORONE"}, {"promo": "OLD"}, {"promo": "FULL"},
             {"promo": "LAST"}, {"promo": "LAST"}, {"promo": "SAVE20", "items": '[{"item_id":2,"quantity":1}]'}, {"promo": "BIG"},
             {"promo": "NOSUCH"}]
    rows = {r["order_id"]: (r["promotion_id"], r["discount_amount"], r["delivery_fee"]) for r in dicts(
        requests.place_orders(shop, ask(spark, *cases), TODAY).orders)}
    fee = Decimal("39.00")
    assert rows == {
        1: (1, Decimal("80.00"), fee),                 # 20 % of 1000, capped
        2: (3, Decimal("0.00"), Decimal("0.00")), 3: (4, Decimal("0.00"), fee),
        4: (None, Decimal("0.00"), fee), 5: (None, Decimal("0.00"), fee),
        6: (7, Decimal("75.00"), fee), 7: (None, Decimal("0.00"), fee),   # the last use goes to the first request
        8: (None, Decimal("0.00"), fee), 9: (8, Decimal("487.00"), fee), 10: (None, Decimal("0.00"), fee)}


def test_rejects(spark, shop):
    cases = [{"customer": 2}, {"customer": 9}, {"restaurant": 2}, {"items": '[{"item_id":4,"quantity":1}]'},
             {"items": '[{"item_id":1,"quantity":1},{"item_id":77,"quantity":1}]'}, {"items": "{broken"}, {"items": None, "customer": 9},
             {"items": '[{"item_id":1}]'}, {"items": '[{"quantity":1}]'}, {"items": "[null]"}]
    placed = requests.place_orders(shop, ask(spark, *cases), TODAY)
    assert {r["request_id"]: r["error_code"] for r in dicts(placed.rejects)} == {
        1: "P0001", 2: "P0001", 3: "P0002", 4: "P0003", 5: "P0003", **dict.fromkeys(range(6, 11), "22P02")}
    assert placed.orders.count() == placed.items.count() == 0


def changes(spark, rows, names):
    df = spark.createDataFrame(rows, names)
    return df.withColumn("requested_at", F.col("requested_at").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def open_orders(spark):
    statuses = {1: "Placed", 2: "Delivered", 3: "Cancelled"}
    orders = [{"order_id": i, "order_status": s, "total_amount": 487, "zone_id": 11, "order_timestamp": "2024-06-01 09:00:00"}
              for i, s in statuses.items()]
    pays = [{"payment_id": i, "order_id": i, "amount": 487, "payment_status": "Completed"} for i in statuses]
    return market(spark, orders=orders, payments=pays, deliveries=[
        {"delivery_id": 5, "order_id": 1, "partner_id": 7, "delivery_fee": 39, "distance_km": 1},
        {"delivery_id": 6, "order_id": 2, "partner_id": 8, "delivery_fee": None, "distance_km": None}])


def test_cancel(spark, open_orders):
    rows = [(1, 1, None, "2024-06-01"), (2, 1, "again", "2024-06-02"), (3, 2, None, "2024-06-01"), (4, 3, None, "2024-06-01"),
            (5, 99, None, "2024-06-01")]
    out = requests.cancel_orders(open_orders, changes(spark, rows, "request_id long, order_id long, reason string, requested_at string"))
    assert [(r["order_id"], r["cancellation_reason"]) for r in dicts(out.orders)] == [(1, "Customer requested cancellation")]
    assert [(r["order_id"], r["refund_amount"]) for r in dicts(out.payments)] == [(1, Decimal("487.00"))]
    assert {r["request_id"] for r in dicts(out.rejects)} == {2, 3, 4, 5}


def test_refunds(spark, open_orders):
    rows = [(1, 1, Decimal("500"), "2024-06-01"), (2, 1, Decimal("100"), "2024-06-02"), (3, 1, None, "2024-06-03"),
            (4, 2, None, "2024-06-01"), (5, 99, None, "2024-06-01")]
    names = "request_id long, order_id long, amount decimal(10,2), requested_at string"
    out = requests.process_refunds(open_orders, changes(spark, rows, names))
    assert {(r["order_id"], r["payment_status"], r["refund_amount"]) for r in dicts(out.payments)} == {
        (1, "Partially Refunded", Decimal("100.00")), (2, "Refunded", Decimal("487.00"))}
    said = {r["request_id"]: r["message"] for r in dicts(out.rejects)}
    assert said[1].startswith("Refund amount (500.00)") and said[3].startswith("No completed") and set(said) == {1, 3, 5}


def test_assignment(spark):
    partners = [{"partner_id": i, "partner_name": f"P{i}", "zone_id": z, "city_id": 1, "is_active": True,
                 "current_status": "Available", "bg_verification": ok, "total_deliveries": n, "rating": 4}
                for i, z, ok, n in ((1, 11, True, 5), (2, 11, True, 9), (3, 12, False, 1))]
    orders = [{"order_id": i, "order_status": "Placed", "zone_id": 11, "order_timestamp": f"2024-06-01 10:0{i}:00"}
              for i in range(4)]
    m = market(spark, delivery_partners=partners, orders=orders, zones=[
        {"zone_id": z, "city_id": 1, "avg_delivery_time_mins": 30} for z in (11, 12)])
    out = requests.assign_partners(m, requests.waiting_orders(m))
    assert {r["order_id"]: (r["partner_id"], r["matched_by"]) for r in dicts(out.deliveries)} == {
        0: (2, "zone"), 1: (1, "zone"), 2: (3, "city")}
    assert [(r["order_id"], r["error_code"]) for r in dicts(out.rejects)] == [(3, "P0010")]
    assert {(r["order_id"], r["order_status"]) for r in dicts(out.orders)} == {(i, "Confirmed") for i in range(3)}
    assert {(r["partner_id"], r["current_status"]) for r in dicts(out.partners)} == {(i, "On Delivery") for i in (1, 2, 3)}


def test_completion(spark, open_orders):
    rows = [(1, 1, 30, Decimal("9.0"), "2024-06-01"), (2, 1, 35, Decimal("4.5"), "2024-06-02"), (3, 2, 20, None, "2024-06-01"),
            (4, 99, 20, None, "2024-06-01")]
    names = "request_id long, order_id long, actual_mins int, distance_km decimal(6,2), requested_at string"
    out = requests.complete_deliveries(open_orders, changes(spark, rows, names))
    got = {r["order_id"]: (r["actual_time_mins"], r["partner_earnings"]) for r in dicts(out.deliveries)}
    assert got == {1: (35, Decimal("36.30")), 2: (20, Decimal("33.30"))}   # 39 x 0.7 + 4.5 x 2; defaults 39 and 3 km
    assert [r["order_id"] for r in dicts(out.rejects)] == [99]
    assert {r["order_id"] for r in dicts(out.orders)} == {1, 2} and {r["partner_id"] for r in dicts(out.partners)} == {7, 8}
    # A distance given once outlives a later request without one; earnings follow the last request.
    rows = [(1, 1, 30, Decimal("5.0"), "2024-06-01"), (2, 1, 35, None, "2024-06-02")]
    row = dicts(requests.complete_deliveries(open_orders, changes(spark, rows, names)).deliveries)[0]
    assert (row["distance_km"], row["partner_earnings"]) == (Decimal("5.00"), Decimal("33.30"))


def test_state_machines():
    assert set(ORDER_MOVES) == set(ORDER_STATUSES)
    assert all(t in ORDER_STATUSES for ts in ORDER_MOVES.values() for t in ts)
    assert "Cancelled" not in ORDER_MOVES["On The Way"] and ORDER_MOVES["Delivered"] == ()
    assert DELIVERY_MOVES["En Route to Customer"] == ("Delivered", "Failed") and "Assigned" in DELIVERY_MOVES["Pending"]


def test_validation_finds_planted_errors(spark):
    orders = [
        {"order_id": 1, "customer_id": 1, "order_status": "Cancelled", "subtotal_amount": 100, "discount_amount": 0,
         "delivery_fee": 0, "taxes": 5, "total_amount": 105, "order_timestamp": "2024-01-01 00:00:00"},
        {"order_id": 1, "customer_id": 9, "order_status": "Lost", "subtotal_amount": 100, "discount_amount": 200,
         "delivery_fee": 0, "taxes": 0, "total_amount": 99, "order_timestamp": "2025-01-01 00:00:00"}]
    m = market(spark, orders=orders, customers=[{"customer_id": 1}], reviews=[{"review_id": 1, "order_id": 1, "food_rating": 6}],
               order_status_history=[
                   {"history_id": i, "order_id": 1, "status": s, "changed_at": f"2024-01-01 00:0{i}:00"}
                   for i, s in enumerate(["Placed", "Confirmed", "Delivered", "Delivered"])])
    failed = {(r["table_name"], r["rule_id"]): r["n_failed"] for r in dicts(quality.validate_rows(
        m, TODAY, ["orders", "reviews"])) if not r["passed"]}
    assert failed[("orders", "D8 total adds up")] == 1 and failed[("orders", "D6 order_status known")] == 1
    assert failed[("orders", "D7 discount within subtotal")] == 1 and failed[("orders", "D10 not in the future")] == 1
    assert failed[("orders", "D9 cancellation has a reason")] == 1 and failed[("reviews", "D5 food_rating in range")] == 1
    assert failed[("orders", "D4 restaurant_id not null")] == 2
    keys = {r["rule_id"]: r["n_failed"] for r in dicts(quality.validate_keys(m, tables=["orders"]))}
    refs = {r["rule_id"]: r["n_failed"] for r in dicts(quality.validate_references(m, tables=["orders"]))}
    assert keys == {"D1 primary key": 1} and refs["D3 customer_id references customers"] == 1
    assert dicts(quality.illegal_transitions(m)) and dicts(quality.legal_transitions(m))[0]["n_failed"] == 2
    assert quality.rejects(m, "orders", "D8 total adds up", TODAY).count() == 1


def test_seeds(spark):
    zones = {r["zone_id"]: (r["zone_name"], r["avg_delivery_time_mins"]) for r in dicts(seeds.zones(spark))}
    assert len(zones) == 100 and zones[1] == ("Mumbai Zone 1 - Andheri", 28) and zones[40] == ("Hyderabad Zone 10", 40)
    mine = frame(spark, "cities", [{"city_id": 1, "city_name": "Mine"}])
    merged = {r["city_id"]: r["city_name"] for r in dicts(seeds.insert_missing(mine, seeds.cities(spark), "city_id"))}
    assert len(merged) == 10 and merged[1] == "Mine"
    assert {r["entity"]: r["rows"] for r in dicts(seeds.row_counts(
        cities=seeds.cities(spark), promotions=seeds.promotions(spark)))} == {"cities": 10, "promotions": 10}


def test_csv_loader(spark, tmp_path):
    (tmp_path / "orders_2024_01.csv").write_text(
        "order_id,customer_id,restaurant_id,zone_id,order_timestamp,order_status,order_channel,subtotal_amount,discount_amount,"
        "delivery_fee,taxes,total_amount,platform_commission,payment_method,cancellation_reason\n"
        "1,1,1,,2024-01-31 23:59:59,Delivered,App,100.00,0.00,0.00,5.00,105.00,21.00,UPI,\n")
    (tmp_path / "deliveries.csv").write_text(
        "order_id,partner_id,actual_time_mins,expected_time_mins,delivery_status,unknown\n1,3,46,46,Delivered,x\n")
    m = csv_tables.load_csv(spark, str(tmp_path), "orders", "deliveries")
    row = dicts(m.orders())[0]
    assert (row["order_date"], row["zone_id"], row["cancellation_reason"], row["total_amount"]) == (
        date(2024, 1, 31), None, None, Decimal("105.00"))
    trip = dicts(m.deliveries())[0]
    assert (trip["sla_breached"], trip["on_time"], trip["delivery_id"]) == (True, True, 1)


def test_stored_orders_prune_months(spark, tmp_path):
    m = market(spark, orders=[{"order_id": i, "order_timestamp": f"2024-{i:02d}-15 10:00:00", "total_amount": 1} for i in range(1, 13)])
    store.write_store(m, str(tmp_path), ["orders"])
    df = store.open_store(spark, str(tmp_path), ["orders"]).orders("order_id", since=date(2024, 3, 10), until=date(2024, 5, 1))
    assert sorted(r["order_id"] for r in df.collect()) == [3, 4]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "order_id" in plan.split("ReadSchema")[1]


def test_a_customer_reads_one_folder(spark, tmp_path):
    rows = [{"order_id": i, "customer_id": i % 40, "order_timestamp": f"2024-0{1 + i % 6}-01 00:00:00"} for i in range(200)]
    m = market(spark, orders=rows)
    store.write_store(m, str(tmp_path), ["orders"])
    got = store.order_history(spark, str(tmp_path), 7, "order_id", "customer_id")
    assert sorted(r["order_id"] for r in dicts(got)) == [i for i in range(200) if i % 40 == 7]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(customer_bucket" in plan and "PushedFilters: [IsNotNull(customer_id)" in plan
    files = {r["f"].split("customer_bucket=")[1].split("/")[0] for r in got.select(F.input_file_name().alias("f")).collect()}
    assert len(files) == 1


def test_refresh_switches_versions(spark, tmp_path):
    def shop_of(n):
        return market(spark, orders=[{"order_id": i, "order_timestamp": "2024-01-15 10:00:00", "order_status": "Delivered",
                                      "customer_id": 1, "restaurant_id": 1, "total_amount": 1} for i in range(n)])

    base = str(tmp_path)
    refresh.refresh(shop_of(2), TODAY, base, ["daily_kpi"])
    m = refresh.attach_views(shop_of(5), base)
    from plateflow.operators.views import daily_kpi
    assert dicts(daily_kpi(m))[0]["total_orders"] == 2        # the stored copy is read
    refresh.refresh(shop_of(5), TODAY, base, ["daily_kpi"])
    assert dicts(daily_kpi(refresh.attach_views(shop_of(5), base)))[0]["total_orders"] == 5
    assert daily_kpi(m).count() == 1                           # readers of the old version are not broken
    with pytest.raises(ValueError):
        refresh.materialise(shop_of(2).orders("order_id").selectExpr("1 as k"), f"{base}/x", ["k"], ["k"], TODAY)


def test_report_survives_a_failure(spark, shop, tmp_path, monkeypatch):
    monkeypatch.setitem(runner.QUERIES, "broken", lambda m, as_of: 1 / 0)
    report = runner.run_report(shop, TODAY, str(tmp_path), ["broken", "nonsense", "platform_kpis"])
    assert "division" in report["results"]["broken"]["error"] and report["results"]["nonsense"]["error"] == "unknown query"
    assert report["results"]["platform_kpis"]["rows"] == 1
    saved = json.loads("\n".join(r["value"] for r in spark.read.text(f"{tmp_path}/analytics_report").collect()))
    assert saved["results"].keys() == report["results"].keys()


def feed(spark, rows):
    df = spark.createDataFrame(rows, "order_id long, status string, changed_at string, customer_id long, total_amount double")
    return df.withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz"))


def test_stream_counts_replays_once_and_survives_restarts(spark, tmp_path):
    first = [(1, "Placed", "2024-01-01 10:00:00", 5, 10.0), (1, "Delivered", "2024-01-01 10:30:00", 5, 10.0),
             (1, "Delivered", "2024-01-01 10:30:00", 5, 10.0), (2, "Delivered", "2024-01-01 10:31:00", 5, 20.0)]
    second = [(2, "Delivered", "2024-01-01 10:32:00", 5, 20.0), (3, "Delivered", "2024-01-01 10:33:00", 6, 7.0)]
    base = str(tmp_path)

    def step(rows):
        feed(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = keep.file_stream(spark, f"{base}/in", feed(spark, first).schema)
        keep.stream_totals(stream, "customer_id", "total_amount", f"{base}/out", f"{base}/cp")
        kept = keep.read_events(spark, f"{base}/out", "order_id")
        rows = dicts(keep.customer_totals(keep.totals(kept, "customer_id", "total_amount")))
        return {r["customer_id"]: (r["total_orders"], float(r["total_spent"])) for r in rows}

    assert step(first) == {5: (2, 30.0)}
    assert step(second) == {5: (2, 30.0), 6: (1, 7.0)}
    keep.compact(spark, f"{base}/out", f"{base}/small", "order_id")
    small = keep.totals(keep.read_events(spark, f"{base}/small", "order_id"), "customer_id", "total_amount")
    assert {r["customer_id"]: r["n"] for r in dicts(small)} == {5: 2, 6: 1}


def test_late_files_count(spark, tmp_path):
    """Three files of ten orders, the second one hours older than the first."""
    base = str(tmp_path)
    for n, hour in enumerate((20, 3, 23)):
        rows = [(10 * n + k, "Delivered", f"2024-01-01 {hour:02d}:{k:02d}:00", k % 3, 1.0) for k in range(10)]
        feed(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = keep.file_stream(spark, f"{base}/in", feed(spark, rows).schema, max_files=1)
    keep.stream_totals(stream, "customer_id", "total_amount", f"{base}/out", f"{base}/cp")
    got = keep.totals(keep.read_events(spark, f"{base}/out", "order_id"), "customer_id", "total_amount")
    assert sum(r["n"] for r in dicts(got)) == 30


@pytest.mark.parametrize("folder", [True, False])
def test_a_late_event_counts_in_its_closed_window(spark, tmp_path, folder):
    base = str(tmp_path)
    rows = [(1, "2024-01-01 10:05:00"), (2, "2024-01-01 12:30:00"), (3, "2024-01-01 10:10:00"), (4, "2024-01-01 14:30:00")]
    df = spark.createDataFrame(rows, "event_id long, t string").select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("changed_at"), F.lit(100).cast("long").alias("cents"))
    df.repartition(3, "event_id").write.parquet(f"{base}/in")
    if not folder:
        df.coalesce(1).write.parquet(f"{base}/one")
        name = next(p.name for p in (tmp_path / "one").iterdir() if p.name.endswith(".parquet"))
        (tmp_path / "one" / name).rename(tmp_path / "events.parquet")
    path = f"{base}/in" if folder else f"{base}/events.parquet"
    keep.stream_demand(keep.file_stream(spark, path, df.schema, max_files=1), f"{base}/out", f"{base}/cp")
    kept = keep.read_events(spark, f"{base}/out", "event_id")
    got = {str(r["window_start"])[11:13]: (r["events"], r["is_closed"]) for r in keep.closing_windows(kept).collect()}
    assert got == {"10": (2, True), "12": (1, True), "14": (1, False)}


def test_audit_log_does_not_depend_on_arrival(spark, tmp_path):
    base = str(tmp_path)
    parts = [[(4, 7, "Confirmed", "2024-01-01 10:03:00"), (2, 7, "Placed", "2024-01-01 10:01:00")],
             [(1, 7, "Placed", "2024-01-01 10:00:00"), (3, 7, "Placed", "2024-01-01 10:02:00"), (4, 7, "Confirmed", "2024-01-01 10:03:00")]]
    for part in parts:
        df = spark.createDataFrame(part, "event_id long, order_id long, status string, changed_at string").withColumn(
            "changed_at", F.col("changed_at").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        keep.stream_status(keep.file_stream(spark, f"{base}/in", df.schema), f"{base}/out", f"{base}/cp")
    log = keep.audit_log(keep.read_events(spark, f"{base}/out", "event_id"))
    assert sorted((r["from_status"] or "", r["status"]) for r in dicts(log)) == [("", "Placed"), ("Placed", "Confirmed")]
    assert [str(r["changed_at"])[11:] for r in dicts(keep.first_status(log))] == ["10:00:00"]


def test_a_stream_without_events(spark, tmp_path):
    base = str(tmp_path)
    feed(spark, []).write.parquet(f"{base}/in")
    stream = keep.file_stream(spark, f"{base}/in", feed(spark, []).schema)
    keep.stream_totals(stream, "customer_id", "total_amount", f"{base}/out", f"{base}/cp")
    assert keep.read_events(spark, f"{base}/out", "order_id").collect() == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_assignment_is_that_of_a_loop(spark, seed):
    """Orders one by one against the batch: zones run dry, fallbacks take partners that later orders wanted."""
    import random

    rng = random.Random(seed)
    zones = {z: 1 + z % 2 for z in range(6)}
    partners = [{"partner_id": i, "partner_name": f"P{i}", "zone_id": rng.randrange(6), "is_active": rng.random() > 0.1,
                 "current_status": rng.choice(["Available", "Available", "Offline"]), "bg_verification": rng.random() > 0.3,
                 "total_deliveries": rng.randrange(4), "rating": rng.choice([None, 3, 4])} for i in range(40)]
    orders = [{"order_id": i, "order_status": "Placed", "zone_id": rng.choice([*range(6), 99, None]),
               "order_timestamp": f"2024-06-01 10:{rng.randrange(30):02d}:00"} for i in range(60)]
    m = market(spark, delivery_partners=partners, orders=orders, zones=[
        {"zone_id": z, "city_id": c, "avg_delivery_time_mins": 30} for z, c in zones.items()])
    free = {p["partner_id"]: p for p in partners if p["is_active"] and p["current_status"] == "Available"}
    want, lost = {}, set()
    for o in sorted(orders, key=lambda o: (o["order_timestamp"], o["order_id"])):
        near = [p for p in free.values() if p["zone_id"] == o["zone_id"] and p["bg_verification"]]
        city = zones.get(o["zone_id"])
        far = [p for p in free.values() if city is not None and zones[p["zone_id"]] == city]
        if near:
            one = min(near, key=lambda p: (-p["total_deliveries"], p["rating"] is not None, -(p["rating"] or 0), p["partner_id"]))
        elif far:
            one = min(far, key=lambda p: p["partner_id"])
        else:
            lost.add(o["order_id"])
            continue
        want[o["order_id"]] = (one["partner_id"], "zone" if near else "city")
        del free[one["partner_id"]]
    out = requests.assign_partners(m, requests.waiting_orders(m))
    assert {r["order_id"]: (r["partner_id"], r["matched_by"]) for r in dicts(out.deliveries)} == want
    assert {r["order_id"] for r in dicts(out.rejects)} == lost


def test_filled_zones(spark):
    places = spark.createDataFrame([(3, "Bangalore"), (4, "Hyderabad")], "city_id long, city_name string")
    rows = {r["zone_id"]: (r["zone_name"], r["avg_delivery_time_mins"]) for r in dicts(seeds.fill_zones(places, 2))}
    assert rows == {5: ("Bangalore Zone 1", 22), 6: ("Bangalore Zone 2", 24), 7: ("Hyderabad Zone 1", 22), 8: ("Hyderabad Zone 2", 24)}


def test_history_of_a_customer_with_most_orders_and_of_none(spark, tmp_path):
    rows = [{"order_id": i, "customer_id": 5 if i % 2 else i, "order_timestamp": f"2024-01-01 00:{i % 60:02d}:00"} for i in range(400)]
    store.write_store(market(spark, orders=rows), str(tmp_path), ["orders"])
    got = store.order_history(spark, str(tmp_path), 5, "order_id")
    assert got.count() == 200 and store.order_history(spark, str(tmp_path), 10**9).count() == 0
