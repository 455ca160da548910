"""Order, cancellation, refund, assignment and completion requests, applied as batches.

Each job takes a DataFrame of requests and returns DataFrames of the rows to write and
of the rejected requests. Within a batch, requests count in the order of
(requested_at, request_id), as if they had arrived one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plateflow.functions.ordering import Want, add_orders, asc, desc
from plateflow.functions.skew import hot_keys, join_spread
from plateflow.model import DEFAULT_FEE, Marketplace
from plateflow.session import delete, kept, scratch, written

ITEMS = "array<struct<item_id:long,quantity:int>>"
# Error codes of the order service.
NO_CUSTOMER, NO_RESTAURANT, NO_ITEM, NO_PARTNER = "P0001", "P0002", "P0003", "P0010"
BAD_ITEMS = "22P02"
# Lines beyond this number are priced in several passes, each with its share of the items: only one share lies in shuffle files.
LINES_AT_ONCE, PASSES = 1_000_000, 4


@dataclass(frozen=True)
class Placed:
    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    rejects: DataFrame


def _money(value: Column, digits: int = 10) -> Column:
    return F.round(value, 2).cast(f"decimal({digits},2)")


def transaction_id(order_id: Column) -> Column:
    """``TXN`` and the order number, padded to ten digits but never cut."""
    text = order_id.cast("string")
    return F.concat(F.lit("TXN"), F.call_function("lpad", text, F.greatest(F.lit(10), F.length(text)), F.lit("0")))


def _lines(parsed: DataFrame) -> DataFrame:
    return parsed.select("request_id", F.posexplode("_items").alias("_pos", "_item")).select(
        "request_id", "_pos", "_item.item_id", "_item.quantity")


def _priced(lines: DataFrame, menu: DataFrame, hot: DataFrame) -> DataFrame:
    return join_spread(lines, menu, "item_id", "request_id", how="left", counts=hot)


def _carts(asked: DataFrame, menu: DataFrame, hot: DataFrame, folder: str) -> DataFrame:
    """Subtotal and first unavailable item of each request."""
    lines, count = _lines(asked), asked.agg(F.sum(F.size("_items"))).first()[0] or 0
    passes = PASSES if count > LINES_AT_ONCE else 1
    place = F.pmod(F.xxhash64(F.col("item_id").cast("long")), F.lit(passes))
    missing = ~F.coalesce(F.col("is_available"), F.lit(False))
    for i in range(passes):
        priced = _priced(lines, menu, hot) if passes == 1 else _priced(lines.filter(place == i), menu.filter(place == i), hot)
        # Only what the sums need goes on; the price of a whole line is exact.
        priced = written(priced.select(
            "request_id", (F.col("price") * F.col("quantity")).alias("_amount"),
            F.when(missing, F.col("item_id")).alias("_bad"), F.when(missing, F.col("_pos")).alias("_bad_pos")),
            f"{folder}/priced", "append")
    carts = written(priced.groupBy("request_id").agg(
        F.sum("_amount").alias("_subtotal"), F.min_by("_bad", "_bad_pos").alias("_bad_item")), f"{folder}/carts")
    delete(asked.sparkSession, f"{folder}/priced")
    return carts


def _judged(m: Marketplace, asked: DataFrame, carts: DataFrame, folder: str) -> DataFrame:
    """Requests with their subtotal, the error of each (or NULL), and what comes from their restaurant.

    Each table is looked up in a step of its own; ``folder``/asked, which is ``asked``, is deleted after the first one.
    """
    spark, heads = asked.sparkSession, asked.drop("_items")
    people = m.customers("customer_id", "is_active").withColumnRenamed("is_active", "_customer_ok")
    rests = m.restaurants("restaurant_id", "is_active", "zone_id", "commission_rate").withColumnRenamed(
        "is_active", "_restaurant_ok")
    df = join_spread(heads, people, "customer_id", "request_id", how="left", counts=hot_keys(heads, "customer_id"))
    df = written(df, f"{folder}/people")
    delete(spark, f"{folder}/asked")
    df = join_spread(df, rests, "restaurant_id", "request_id", how="left", counts=hot_keys(df, "restaurant_id"))
    df = written(df, f"{folder}/checked")
    delete(spark, f"{folder}/people")
    df = df.join(carts, "request_id", "left")
    no = F.lit(False)
    code = (
        F.when(F.col("_broken"), BAD_ITEMS).when(~F.coalesce("_customer_ok", no), NO_CUSTOMER).when(~F.coalesce("_restaurant_ok", no), NO_RESTAURANT)
        .when(F.col("_bad_item").isNotNull(), NO_ITEM)
    )
    return df.withColumns({"error_code": code, "_sub": F.coalesce("_subtotal", F.lit(0)).cast("decimal(10,2)")}).drop(
        "_broken", "_customer_ok", "_restaurant_ok", "_subtotal")


def _live(m: Marketplace, as_of: date) -> DataFrame:
    """Promotions that can be used on a day, with the number of uses left (NULL: any)."""
    promos = m.promotions("promotion_id", "promo_code", "promo_type", "discount_value", "min_order_amount",
                          "max_discount", "max_uses", "current_uses", "start_date", "end_date", "is_active")
    today = F.lit(as_of)
    live = promos.filter(F.col("is_active") & today.between(F.col("start_date"), F.col("end_date"))
                         & (F.col("max_uses").isNull() | (F.col("current_uses") < F.col("max_uses"))))
    return live.select("promo_code", "promotion_id", "promo_type", "discount_value", "min_order_amount",
                       "max_discount", (F.col("max_uses") - F.col("current_uses")).alias("_left"))


def place_orders(m: Marketplace, requests: DataFrame, as_of: date) -> Placed:
    """Validate, price and record order requests.

    ``requests``: request_id, customer_id, restaurant_id, address_id, items (JSON array of
    item_id and quantity), promo_code, payment_method, order_channel, requested_at. The
    request number becomes the order number. A list of items that is missing, no JSON array, or
    has an entry without item or quantity is rejected before anything else is looked at.

    Requests are parsed, priced, checked and judged in steps, each written as Parquet, so that a step's
    shuffle files and input are gone when the next one starts. Whoever reads the items prices their lines again.
    """
    whole = F.forall("_items", lambda x: x["item_id"].isNotNull() & x["quantity"].isNotNull())
    parsed = requests.withColumn("_items", F.from_json("items", ITEMS)).select(
        "request_id", "customer_id", "restaurant_id", "address_id", "promo_code", "payment_method", "order_channel",
        "requested_at", "_items", (~F.coalesce(whole, F.lit(False))).alias("_broken"))
    menu = m.menu_items("item_id", "price", "is_available")
    with scratch(requests.sparkSession) as folder:
        asked = written(parsed, f"{folder}/asked")
        hot_items = hot_keys(_lines(asked), "item_id")
        carts = _carts(asked, menu, hot_items, folder)
        judged = kept(_judged(m, asked, carts, folder))
    reason = (
        F.when(F.col("error_code") == BAD_ITEMS, F.lit("Items are no list of item_id and quantity"))
        .when(F.col("error_code") == NO_CUSTOMER, F.concat(
            F.lit("Customer "), F.col("customer_id").cast("string"), F.lit(" not found or inactive")))
        .when(F.col("error_code") == NO_RESTAURANT, F.concat(
            F.lit("Restaurant "), F.col("restaurant_id").cast("string"), F.lit(" not found or inactive")))
        .otherwise(F.concat(F.lit("Item "), F.col("_bad_item").cast("string"), F.lit(" not available")))
    )
    rejects = judged.filter("error_code is not null").select("request_id", "error_code", reason.alias("message"))

    # Stored first, so that Spark knows their size: few promotions, or few requests without a place, move no request.
    ok = judged.filter("error_code is null").join(kept(_live(m, as_of)), "promo_code", "left")
    fits = F.col("promotion_id").isNotNull() & (F.col("_sub") >= F.col("min_order_amount"))
    ok = ok.withColumn("_promo", F.when(fits, F.col("promotion_id")))
    # A limited promotion serves the first requests only; their places need a ranking per promotion.
    limited = ok.filter("_promo is not null and _left is not null").select("request_id", "requested_at", "_promo", "_left")
    placed = add_orders(limited, ["request_id"],
                        Want((asc("requested_at"),), partition=("_promo",), row_number="_place"))
    spent = kept(placed.filter(F.col("_place") > F.col("_left")).select("request_id", F.lit(True).alias("_spent")))
    ok = ok.join(spent, "request_id", "left").withColumn("_promo", F.when(F.col("_spent").isNull(), F.col("_promo")))

    has, kind, sub = F.col("_promo").isNotNull(), F.col("promo_type"), F.col("_sub")
    cap = F.coalesce("max_discount", F.lit(999999))
    discount = (
        F.when(has & (kind == "FLAT"), F.least("discount_value", sub))
        .when(has & (kind == "PERCENT"), F.least(sub * F.col("discount_value") * F.lit(Decimal("0.01")), cap))
        .otherwise(F.lit(0))
    )
    fee = F.when(has & (kind == "FREE_DELIVERY"), F.lit(0)).otherwise(F.lit(DEFAULT_FEE))
    ok = ok.withColumns({"discount_amount": _money(discount, 8), "delivery_fee": fee.cast("decimal(6,2)")})
    taxed = sub - F.col("discount_amount")
    ok = ok.withColumn("taxes", _money(taxed * F.lit(Decimal("0.05")), 8))
    ok = ok.withColumn("total_amount", _money(taxed + F.col("delivery_fee") + F.col("taxes")))
    commission = F.col("total_amount") * F.col("commission_rate") * F.lit(Decimal("0.01"))
    orders = ok.select(
        F.col("request_id").alias("order_id"), "customer_id", "restaurant_id", "address_id", "zone_id",
        F.col("_promo").alias("promotion_id"), F.col("requested_at").alias("order_timestamp"),
        F.lit("Placed").alias("order_status"), "order_channel", sub.alias("subtotal_amount"), "discount_amount",
        "delivery_fee", "taxes", "total_amount", _money(commission, 8).alias("platform_commission"), "payment_method")
    good = orders.select(F.col("order_id").alias("request_id"))
    items = _priced(_lines(parsed), menu, hot_items).join(good, "request_id", "left_semi").select(
        F.col("request_id").alias("order_id"), "item_id", "quantity", F.col("price").alias("unit_price"),
        (F.col("price") * F.col("quantity")).cast("decimal(12,2)").alias("item_total"))
    payments = orders.select(
        "order_id", F.col("total_amount").alias("amount"), "payment_method",
        F.lit("Completed").alias("payment_status"), transaction_id(F.col("order_id")).alias("transaction_id"),
        F.col("order_timestamp").alias("payment_timestamp"))
    return Placed(orders, items, payments, rejects)


@dataclass(frozen=True)
class Applied:
    orders: DataFrame
    payments: DataFrame
    rejects: DataFrame


def _first_per_order(requests: DataFrame) -> DataFrame:
    """Number of the first request of each order (a partial aggregate, whatever the repeats)."""
    return requests.groupBy("order_id").agg(
        F.min_by("request_id", F.struct("requested_at", "request_id")).alias("_first"))


def cancel_orders(m: Marketplace, requests: DataFrame) -> Applied:
    """Cancel open orders and refund their completed payments.

    ``requests``: request_id, order_id, reason, requested_at. A repeated request finds the
    order already cancelled.
    """
    firsts = _first_per_order(requests)
    orders = m.orders("order_id", "order_status", "total_amount")
    known = orders.join(firsts, "order_id")
    df = join_spread(requests, known, "order_id", "request_id", how="left")
    status = F.when(F.col("order_status").isNull(), None).when(
        F.col("order_status").isin("Delivered", "Cancelled"), F.col("order_status")).when(
        F.col("_first") != F.col("request_id"), F.lit("Cancelled"))
    message = F.when(F.col("order_status").isNull(), F.concat(
        F.lit("Order "), F.col("order_id").cast("string"), F.lit(" not found"))).when(
        status.isNotNull(), F.concat(F.lit("Cannot cancel order in status: "), status))
    df = df.withColumn("message", message)
    done = df.filter("message is null")
    cancelled = done.select("order_id", F.lit("Cancelled").alias("order_status"),
                            F.col("requested_at").alias("cancelled_at"),
                            F.coalesce("reason", F.lit("Customer requested cancellation")).alias("cancellation_reason"))
    paid = m.payments("payment_id", "order_id", "payment_status").filter(F.col("payment_status") == "Completed")
    refunds = paid.join(done.select("order_id", "total_amount", "requested_at"), "order_id").select(
        "payment_id", "order_id", F.lit("Refunded").alias("payment_status"),
        F.col("total_amount").alias("refund_amount"), F.col("requested_at").alias("refund_timestamp"))
    return Applied(cancelled, refunds, df.filter("message is not null").select("request_id", "order_id", "message"))


def process_refunds(m: Marketplace, requests: DataFrame) -> Applied:
    """Refund completed payments in full or in part.

    ``requests``: request_id, order_id, amount (NULL for all), requested_at. The first
    request within the paid amount settles an order; later ones find no completed payment.
    """
    paid = m.payments("order_id", "amount", "payment_status").filter(
        F.col("payment_status") == "Completed").groupBy("order_id").agg(F.max("amount").alias("_paid"))
    df = join_spread(requests, paid, "order_id", "request_id", how="left")
    df = df.withColumn("_refund", F.coalesce("amount", "_paid").cast("decimal(10,2)"))
    at = F.struct("requested_at", "request_id")
    winners = df.filter(F.col("_refund") <= F.col("_paid")).groupBy("order_id").agg(F.min(at).alias("_win"))
    df = join_spread(df, winners, "order_id", "request_id", how="left")
    none = F.concat(F.lit("No completed payment for order "), F.col("order_id").cast("string"))
    over = F.concat(F.lit("Refund amount ("), F.col("_refund").cast("string"), F.lit(") exceeds paid amount ("),
                    F.col("_paid").cast("string"), F.lit(")"))
    late = F.col("_win").isNotNull() & (at > F.col("_win"))
    message = F.when(F.col("_paid").isNull() | late, none).when(F.col("_refund") > F.col("_paid"), over)
    df = df.withColumn("message", message)
    done = df.filter("message is null")
    full = F.col("_refund") == F.col("_paid")
    payments = done.select(
        "order_id", F.when(full, "Refunded").otherwise("Partially Refunded").alias("payment_status"),
        F.col("_refund").alias("refund_amount"), F.col("requested_at").alias("refund_timestamp"))
    orders = done.select("order_id", F.lit(True).alias("is_refunded"), F.col("_refund").alias("refund_amount"))
    return Applied(orders, payments, df.filter("message is not null").select("request_id", "order_id", "message"))


@dataclass(frozen=True)
class Assigned:
    """Changes to deliveries, to their orders and to their partners, and what was rejected."""

    deliveries: DataFrame
    orders: DataFrame
    partners: DataFrame
    rejects: DataFrame


def waiting_orders(m: Marketplace) -> DataFrame:
    """Open orders without a delivery."""
    open_ = m.orders("order_id", "order_timestamp", "zone_id", "order_status").filter(
        ~F.col("order_status").isin("Delivered", "Cancelled")).drop("order_status")
    return open_.join(m.deliveries("order_id"), "order_id", "left_anti")


PAIRS = "order_id long, partner_id long, matched_by string"


def _first_come(orders: pd.DataFrame, partners: pd.DataFrame) -> pd.DataFrame:
    """One city: each order in turn takes the best partner of its zone that is left, else the first one of the city."""
    partners = partners.sort_values("_choice")
    lines = {zone: iter(rows["partner_id"].tolist()) for zone, rows in partners[partners["_in_zone"]].groupby("zone_id")}
    anyone = iter(sorted(partners["partner_id"].tolist()))
    taken, pairs = set(), []
    for order, zone in orders.sort_values("_k")[["order_id", "zone_id"]].itertuples(index=False):
        found, by = next((p for p in lines.get(zone, ()) if p not in taken), None), "zone"
        if found is None:
            found, by = next((p for p in anyone if p not in taken), None), "city"
        if found is not None:
            taken.add(found)
            pairs.append((order, found, by))
    return pd.DataFrame(pairs, columns=["order_id", "partner_id", "matched_by"])


def assign_partners(m: Marketplace, orders: DataFrame) -> Assigned:
    """Give waiting orders to available partners, one by one in the order of (order_timestamp, order_id).

    An order takes the best free partner of its zone (verified; most deliveries, then best rating,
    then number), else the free partner of its city with the smallest number; an earlier order may
    so take a partner that a later order of that partner's zone would have got. Assigned orders are
    confirmed and their partners on delivery; the others are rejected.

    Every order of a city that finds anyone takes one partner of that city, so a city with p free
    partners serves exactly its first p orders. Orders are numbered over all tasks, those beyond
    are rejected at once, and a city's turn is played on at most p orders and p partners.
    """
    free = m.delivery_partners("partner_id", "partner_name", "zone_id", "is_active", "current_status",
                               "bg_verification", "total_deliveries", "rating").filter(
        F.col("is_active") & (F.col("current_status") == "Available"))
    zones = m.zones("zone_id", "city_id", "avg_delivery_time_mins")
    ranked = add_orders(
        free.join(zones.select("zone_id", "city_id"), "zone_id").filter("city_id is not null"), ["partner_id"],
        Want((desc("total_deliveries"), desc("rating")), partition=("city_id",), row_number="_choice"))
    seats = ranked.groupBy("city_id").agg(F.count(F.lit(1)).alias("_seats"))
    queue = orders.select("order_id", "order_timestamp", "zone_id").join(zones.select("zone_id", "city_id"), "zone_id", "left")
    queue = add_orders(queue, ["order_id"], Want((asc("order_timestamp"),), partition=("city_id",), row_number="_k"))
    queue = queue.join(seats, "city_id", "left")
    served = F.coalesce(F.col("_k") <= F.col("_seats"), F.lit(False))
    turn = queue.filter(served)
    asking = turn.select(F.col("city_id").alias("asking"), "order_id", "zone_id", "_k")
    offered = ranked.select(F.col("city_id").alias("offered"), "partner_id", "zone_id", "_choice",
                            F.coalesce("bg_verification", F.lit(False)).alias("_in_zone"))
    pairs = asking.groupBy("asking").cogroup(offered.groupBy("offered")).applyInPandas(_first_come, PAIRS)
    rejects = queue.filter(~served).select(
        "order_id", F.lit(NO_PARTNER).alias("error_code"),
        F.concat(F.lit("No available delivery partners for order "), F.col("order_id").cast("string")).alias("message"))
    mins = F.col("avg_delivery_time_mins")
    done = pairs.join(turn.select("order_id", "order_timestamp", "zone_id"), "order_id").join(
        ranked.select("partner_id", "partner_name"), "partner_id").join(zones.drop("city_id"), "zone_id", "left").select(
        "order_id", "partner_id", "partner_name", "matched_by", F.col("order_timestamp").alias("assigned_at"),
        mins.alias("expected_time_mins"),
        (F.col("order_timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), mins)).alias("expected_delivery_time"),
        F.lit("Assigned").alias("delivery_status"))
    confirmed = done.select("order_id", F.lit("Confirmed").alias("order_status"), F.col("assigned_at").alias("confirmed_at"))
    busy = done.select("partner_id", F.lit("On Delivery").alias("current_status"))
    return Assigned(done, confirmed, busy, rejects)


def complete_deliveries(m: Marketplace, requests: DataFrame) -> Assigned:
    """Close deliveries: time, distance and earnings. The last request of an order counts.

    ``requests``: request_id, order_id, actual_mins, distance_km (may be NULL), requested_at. A
    distance given once stays until a later request gives another; earnings follow the last
    request alone. The orders become Delivered and their partners available.
    """
    order = F.struct("requested_at", "request_id")
    last = requests.groupBy("order_id").agg(
        F.max_by(F.struct("request_id", "actual_mins", "distance_km", "requested_at"), order).alias("r"),
        F.max_by("distance_km", F.when(F.col("distance_km").isNotNull(), order)).alias("_given"))
    trips = m.deliveries("delivery_id", "order_id", "partner_id", "distance_km", "delivery_fee")
    done = last.join(trips, "order_id").select(
        "delivery_id", "order_id", "partner_id", F.lit("Delivered").alias("delivery_status"),
        F.col("r.requested_at").alias("delivered_at"), F.col("r.actual_mins").alias("actual_time_mins"),
        F.coalesce("_given", "distance_km").alias("distance_km"),
        _money(F.coalesce("delivery_fee", F.lit(DEFAULT_FEE)) * F.lit(Decimal("0.7"))
               + F.coalesce("r.distance_km", F.lit(Decimal("3.0"))) * 2, 8).alias("partner_earnings"))
    unknown = last.join(trips.select("order_id"), "order_id", "left_anti").select(
        "r.request_id", "order_id", F.concat(F.lit("No delivery record for order "), F.col("order_id").cast("string"))
        .alias("message"))
    delivered = done.select("order_id", F.lit("Delivered").alias("order_status"), "delivered_at")
    back = done.filter("partner_id is not null").select("partner_id").distinct().withColumn(
        "current_status", F.lit("Available"))
    return Assigned(done, delivered, back, unknown)


def restaurant_ratings(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Ratings recomputed from rated reviews; restaurants without any get zero."""
    rated = m.reviews("restaurant_id", "overall_rating").filter("overall_rating is not null").groupBy(
        "restaurant_id").agg(F.round(F.avg(F.col("overall_rating").cast("decimal(10,0)")), 2).alias("_avg"),
                             F.count(F.lit(1)).alias("_n"))
    return m.restaurants("restaurant_id").join(rated, "restaurant_id", "left").select(
        "restaurant_id", F.coalesce("_avg", F.lit(0)).cast("decimal(3,2)").alias("rating"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("total_ratings"))
