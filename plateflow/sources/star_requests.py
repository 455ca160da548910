"""Request batches read off the benchmark star, one request per source row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from plateflow.model import Marketplace
from plateflow.sources.star import ITEM_FACTOR

# Day on which the order requests are priced; the promotions run in these years.
PRICED_ON = date(2023, 6, 15)
CODES = ("WELCOME50", "SAVE20", "FREEDEL", "WEEKEND30", "LOYAL100", "FLASH40", "DINNER25", "NEWREST50", "MONSOON20",
         "FESTIVE100", "NOSUCHCODE")


def order_requests(m: Marketplace) -> DataFrame:
    """Every order asked for again: its lines as JSON, a promotion code by number; two in 211 lists are broken.

    Line items move once, as plain rows, which take less than lists: an order's restaurant, that of its first line, is
    read off the same list as its items.
    """
    sold = m.source.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lines = sold.repartition("l_orderkey").groupBy("l_orderkey").agg(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity"))).alias("_lines"))
    items = F.to_json(F.sort_array(F.transform("_lines", lambda x: F.struct(
        (x["l_suppkey"] * ITEM_FACTOR + x["l_partkey"]).alias("item_id"), x["quantity"].alias("quantity")))))
    orders = m.orders("order_id", "customer_id", "address_id", "payment_method", "order_channel", "order_timestamp")
    pick = F.try_element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("order_id") % 13 + 1).cast("int"))
    return orders.join(lines, F.col("order_id") == F.col("l_orderkey"), "left").select(
        F.col("order_id").alias("request_id"), "customer_id",
        F.coalesce(F.array_min("_lines")["l_suppkey"], F.col("order_id") % 10).alias("restaurant_id"), "address_id",
        F.when(F.col("order_id") % 211 == 7, "{broken").when(F.col("order_id") % 211 == 8, '[{"item_id":1}]')
        .otherwise(F.coalesce(items, F.lit("[]"))).alias("items"), pick.alias("promo_code"), "payment_method", "order_channel",
        F.col("order_timestamp").alias("requested_at"))


def _events(m: Marketplace) -> DataFrame:
    events = m.source.raw("events")
    # Two requests per order; the later orders do not exist.
    return events.withColumn("order_id", F.call_function("div", F.col("event_id"), F.lit(2)) * 4)


def cancel_requests(m: Marketplace) -> DataFrame:
    return _events(m).select(F.col("event_id").alias("request_id"), "order_id", F.col("event_type").alias("reason"),
                             F.col("ts").alias("requested_at"))


def refund_requests(m: Marketplace) -> DataFrame:
    amount = (F.round(F.col("value") * 100).cast("decimal(12,0)") * 10).cast("decimal(10,2)")
    return _events(m).select(F.col("event_id").alias("request_id"), "order_id",
                             F.when(F.col("event_type") != "view", amount).alias("amount"),
                             F.col("ts").alias("requested_at"))


def completion_requests(m: Marketplace) -> DataFrame:
    km = F.round(F.col("value") * 100).cast("decimal(12,0)") * F.expr("0.0001")
    return _events(m).select(F.col("event_id").alias("request_id"), "order_id",
                             (F.col("event_id") % 50 + 10).cast("int").alias("actual_mins"),
                             F.when(F.col("event_type") != "view", F.round(km, 2).cast("decimal(6,2)")).alias("distance_km"),
                             F.col("ts").alias("requested_at"))
