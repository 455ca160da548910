"""Placing orders at size: what stays on disk, passes over the items, repeated and missing keys, hot keys."""

from __future__ import annotations

import gc
import json
import os
import random
import time
from collections import Counter, defaultdict
from datetime import datetime
from decimal import Decimal

import pytest
from frames import dicts, market
from pyspark.sql import functions as F
from test_jobs import PROMOS, REST, TODAY

from plateflow.functions.skew import hot_keys, join_spread
from plateflow.operators import requests
from plateflow.session import kept, scratch, written
from plateflow.sources.star import ITEM_FACTOR, STAR, star_market
from plateflow.sources.star_requests import order_requests

NAMES = "request_id long, customer_id long, restaurant_id long, address_id long, items string, promo_code string, " \
        "payment_method string, order_channel string, requested_at string"
CODES = [p["promo_code"] for p in PROMOS] + [None, "NOSUCH"]


def asked(spark, rows):
    return spark.createDataFrame(rows, NAMES).withColumn("requested_at", F.col("requested_at").cast("timestamp_ntz"))


def some_requests(n, lines, seed=1, odd=0.0):
    """``odd``: share of rows whose number is missing or that of another row."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        cart = [{"item_id": rng.randrange(1, 500), "quantity": rng.randrange(1, 9)} for _ in range(lines)]
        number = rng.choice([None, rng.randrange(n)]) if rng.random() < odd else i
        rows.append((number, rng.choice([1, 1, 1, 1, 2, None]), rng.choice([1, 1, 1, 2]), 1, json.dumps(cart),
                     rng.choice(CODES), "UPI", "App", f"2024-06-01 10:{i // 60 % 60:02d}:{i % 60:02d}"))
    return rows


@pytest.fixture(scope="module")
def shop(spark):
    menu = [{"item_id": i, "restaurant_id": 1, "price": 5 + i % 37, "is_available": i % 50 != 0} for i in range(1, 500)]
    return market(spark, menu_items=menu, restaurants=REST, promotions=PROMOS,
                  customers=[{"customer_id": 1, "is_active": True}, {"customer_id": 2, "is_active": False}])


def shuffled(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [found.apply(i) for i in range(found.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def left_after(spark, work):
    """Bytes of shuffle files that ``work`` leaves, given some seconds for their deletion."""
    before, out = shuffled(spark), work()
    for _ in range(40):
        new = sum(size for name, size in shuffled(spark).items() if name not in before)
        if new < 50_000:
            break
        time.sleep(0.25)
    return new, out


@pytest.mark.parametrize("output", ["orders", "payments"])
def test_shuffle_files_go_with_their_step(spark, shop, output):
    """Once, every join moved all requests or lines twice, and all of it was left on disk until the end."""
    frame = asked(spark, some_requests(3000, 12))
    lines = frame.select("request_id", F.posexplode(F.from_json("items", requests.ITEMS)).alias("_pos", "_item"))
    once, _ = left_after(spark, lambda: lines.repartition(8, "_item.item_id").write.format("noop").mode("append").save())
    assert once > 50_000
    left, placed = left_after(spark, lambda: getattr(requests.place_orders(shop, frame, TODAY), output))
    again, _ = left_after(spark, lambda: placed.write.format("noop").mode("append").save())
    assert left + again < once / 2
    assert "Exchange hashpartitioning" not in placed._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("odd", [0.0, 0.4])
def test_passes_give_the_same(spark, shop, monkeypatch, odd):
    rows = some_requests(400, 3, seed=2, odd=odd) + [
        (9001, 1, 1, 1, '[{"item_id":50,"quantity":1},{"item_id":777,"quantity":1}]', None, "UPI", "App", "2024-06-01 12:00:00"),
        (9002, 1, 1, 1, "[]", None, "UPI", "App", "2024-06-01 12:00:00"), (9003, 1, 1, 1, "{", None, "UPI", "App", "2024-06-01 12:00:00")]
    frame, got = asked(spark, rows), []
    for at_once in (10**9, 0):
        monkeypatch.setattr(requests, "LINES_AT_ONCE", at_once)
        placed = requests.place_orders(shop, frame, TODAY)
        got.append({k: Counter(map(str, getattr(placed, k).collect())) for k in ("orders", "items", "payments", "rejects")})
    assert got[0] == got[1]
    # Subtotals by hand: requests of one number share their lines; without a number there is nothing to find them by.
    sums, bad = defaultdict(Decimal), {}
    for number, *_, items, _code, _pay, _channel, _at in rows:
        for x in json.loads(items) if items != "{" else []:
            if number is not None:
                if x["item_id"] % 50 == 0 or x["item_id"] > 499:
                    bad[number] = True
                if x["item_id"] < 500:
                    sums[number] += (5 + x["item_id"] % 37) * x["quantity"]
    whole = {(r[0], r[1], r[2]) for r in rows if r[4] != "{" and r[1] == 1 and r[2] == 1 and r[0] not in bad}
    orders = dicts(placed.orders)
    assert {(r["order_id"], r["customer_id"], r["restaurant_id"]) for r in orders} == whole
    assert all(r["subtotal_amount"] == sums.get(r["order_id"], 0) for r in orders)
    said = {r["request_id"]: (r["error_code"], r["message"]) for r in dicts(placed.rejects)}
    assert said[9001] == ("P0003", "Item 50 not available") and said[9003][0] == "22P02" and 9002 not in said


def test_hot_keys(spark):
    fact = spark.createDataFrame([(i, 1 if i % 2 else i % 40) for i in range(2000)] + [(-i, None) for i in range(1, 200)],
                                 "rid long, k long")
    hot = hot_keys(fact, "k", 60)
    assert [tuple(r) for r in hot.collect()] == [(1, 1000)]
    assert hot_keys(fact, "k", 10**6).count() == 0
    keyed = spark.range(15).withColumnRenamed("id", "k").withColumn("name", F.concat(F.lit("n"), "k"))
    for how in ("inner", "left"):
        spread = join_spread(fact, keyed, "k", "rid", how=how, hot_rows=60, counts=hot)
        want = fact.join(keyed, "k", how).select("rid", "k", "name")
        assert Counter(spread.select("rid", "k", "name").collect()) == Counter(want.collect())


def test_kept_until_nobody_reads(spark):
    stored = kept(spark.range(5).select("id", F.lit(None).alias("nothing")))
    path = stored.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    shifted = stored.select((F.col("id") + 1).alias("x"), "nothing")
    del stored

    def collected():
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
        return not os.path.exists(path)

    assert not any(collected() for _ in range(3))
    assert [tuple(r) for r in shifted.orderBy("x").collect()] == [(i, None) for i in range(1, 6)]
    del shifted
    assert any(collected() for _ in range(40))


def test_written_leaves_settings(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with scratch(spark) as folder:
        for mode in ("append", "append"):
            twice = written(spark.range(3).repartition(2, "id"), f"{folder}/x", mode)
        assert twice.count() == 6
    assert spark.conf.get(key) == before and not os.path.exists(folder)


def test_order_requests_move_lines_once(spark, tmp_path):
    """Restaurant and items of an order come from one list; orders without lines, missing values, lines and orders that come twice."""
    rng = random.Random(5)
    orders = [(i, i % 7, "O", 1.0, datetime(2000, 1, 1), "1") for i in range(1, 60)] + [(4, 4, "O", 1.0, datetime(2000, 1, 1), "1")]
    lines = [(rng.randrange(1, 55), rng.choice([None, *range(1, 9)]), rng.choice([None, *range(1, 6)]), rng.choice([None, 1, 2, 3]),
              rng.choice([None, 1.0, 17.0]), 1.0, rng.choice([0.01, 0.05]), 0.0, "N", "O", None) for _ in range(150)]
    lines += [*lines[:20], (None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", None)]
    for name, rows in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(rows, STAR[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    found = order_requests(star_market(spark, str(tmp_path)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Relation [l_orderkey") == 1
    nulls_first = lambda values: tuple((v is not None, v or 0) for v in values)
    want = Counter()
    for key, customer, *_ in orders:
        own = sorted((x for x in lines if x[0] == key), key=lambda x: nulls_first((x[3], x[1], x[2], x[4])))
        first = own[0][2] if own else None
        items = sorted(((None if x[1] is None or x[2] is None else x[2] * ITEM_FACTOR + x[1], None if x[4] is None else int(x[4]))
                        for x in own), key=nulls_first)
        text = json.dumps([{k: v for k, v in zip(("item_id", "quantity"), x, strict=True) if v is not None} for x in items],
                          separators=(",", ":"))
        text = "{broken" if key % 211 == 7 else '[{"item_id":1}]' if key % 211 == 8 else text
        want[key, customer, key % 10 if first is None else first, text] += 1
    assert Counter((r["request_id"], r["customer_id"], r["restaurant_id"], r["items"]) for r in found.collect()) == want
