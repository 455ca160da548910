"""Change feeds of the benchmark star and the registered streaming checks over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from plateflow.model import Marketplace
from plateflow.session import cut
from plateflow.streaming import chain, maintain as keep

# Event types read as order states.
STATES = {"signup": "Placed", "view": "Confirmed", "click": "Preparing", "purchase": "Delivered", "error": "Cancelled"}


def status_events(events: DataFrame) -> DataFrame:
    """Raw events as status updates of orders numbered by user."""
    state = F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])
    return events.select(
        "event_id", F.col("user_id").alias("order_id"), state[F.col("event_type")].alias("status"),
        F.col("ts").alias("changed_at"), F.round(F.col("value") * 100).cast("long").alias("cents"))


def event_stream(m: Marketplace) -> DataFrame:
    schema = m.source.raw("events").schema
    return status_events(keep.file_stream(m.spark, f"{m.source.directory}/events.parquet", schema))


def order_changes(m: Marketplace) -> DataFrame:
    """Status history with the figures a change carries."""
    orders = m.orders("order_id", "customer_id", "restaurant_id", "promotion_id", "total_amount")
    return m.order_status_history("order_id", "status", "changed_at").join(orders, "order_id")


def trip_changes(m: Marketplace) -> DataFrame:
    return m.deliveries("order_id", "partner_id", "delivery_status", "delivered_at", "partner_earnings").select(
        "order_id", "partner_id", F.col("delivery_status").alias("status"), F.col("delivered_at").alias("changed_at"),
        "partner_earnings")


def _feed(rows: DataFrame, key: str, first, final) -> DataFrame:
    """Two versions of every entry: as first given, then changed."""
    versions = F.array(F.struct(F.lit(1).alias("version"), first.cast("int").alias("rating")),
                       F.struct(F.lit(2).alias("version"), final.cast("int").alias("rating")))
    return rows.select("entry_id", key, F.explode(versions).alias("v")).select("entry_id", key, "v.*")


def review_feed(m: Marketplace) -> DataFrame:
    rows = m.reviews("review_id", "restaurant_id", "food_rating", "overall_rating").withColumnRenamed(
        "review_id", "entry_id")
    return _feed(rows, "restaurant_id", F.col("food_rating"), F.col("overall_rating"))


def trip_rating_feed(m: Marketplace) -> DataFrame:
    rows = m.deliveries("delivery_id", "partner_id", "delivery_rating").withColumnRenamed(
        "delivery_id", "entry_id")
    return _feed(rows, "partner_id", F.lit(None).cast("int"), F.col("delivery_rating"))


def _replayed(m: Marketplace, feed: DataFrame, take: Callable[[DataFrame, str, str], None],
              read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` finds after ``take`` got the feed as a file stream: every change comes twice, in three
    files without any order, and each file is a micro-batch of its own. The stream's folder is deleted."""
    with keep.passing_workspace(m.spark) as base:
        feed.unionByName(feed).repartition(3).write.parquet(f"{base}/in")
        take(keep.file_stream(m.spark, f"{base}/in", feed.schema, max_files=1), f"{base}/state", f"{base}/cp")
        return cut(read(f"{base}/state"))


def _stream_totals(m: Marketplace, changes: DataFrame, key: str, amount: str) -> DataFrame:
    return _replayed(m, changes, lambda s, path, cp: keep.fold_totals(s, key, amount, path, cp),
                     lambda path: keep.ledger_totals(m.spark, key, amount, path))


def stream_customer_totals(m: Marketplace, as_of=None) -> DataFrame:
    return keep.customer_totals(_stream_totals(m, order_changes(m), "customer_id", "total_amount"))


def stream_restaurant_totals(m: Marketplace, as_of=None) -> DataFrame:
    return keep.restaurant_totals(_stream_totals(m, order_changes(m), "restaurant_id", "total_amount"))


def stream_partner_totals(m: Marketplace, as_of=None) -> DataFrame:
    return keep.partner_totals(_stream_totals(m, trip_changes(m), "partner_id", "partner_earnings"))


def stream_promotion_usage(m: Marketplace, as_of=None) -> DataFrame:
    seeds = m.promotions("promotion_id", "promo_code", "max_uses").withColumn("is_active", F.lit(True))
    return _replayed(m, order_changes(m), keep.fold_promotion_usage,
                     lambda path: keep.with_usage(seeds, keep.USES.figures(m.spark, path)))


def _stream_ratings(m: Marketplace, feed: DataFrame, key: str) -> DataFrame:
    return _replayed(m, feed, lambda s, path, cp: keep.fold_ratings(s, key, path, cp),
                     lambda path: keep.ledger_ratings(m.spark, key, path))


def stream_restaurant_ratings(m: Marketplace, as_of=None) -> DataFrame:
    return _stream_ratings(m, review_feed(m), "restaurant_id")


def stream_partner_ratings(m: Marketplace, as_of=None) -> DataFrame:
    return _stream_ratings(m, trip_rating_feed(m), "partner_id").drop("total_ratings")


def batch_customer_totals(m: Marketplace, as_of=None) -> DataFrame:
    return keep.customer_totals(keep.batch_totals(order_changes(m), "customer_id", "total_amount"))


def batch_restaurant_totals(m: Marketplace, as_of=None) -> DataFrame:
    return keep.restaurant_totals(keep.batch_totals(order_changes(m), "restaurant_id", "total_amount"))


def batch_partner_totals(m: Marketplace, as_of=None) -> DataFrame:
    return keep.partner_totals(keep.batch_totals(trip_changes(m), "partner_id", "partner_earnings"))


def batch_promotion_usage(m: Marketplace, as_of=None) -> DataFrame:
    seeds = m.promotions("promotion_id", "promo_code", "max_uses").withColumn("is_active", F.lit(True))
    return keep.batch_promotion_usage(order_changes(m), seeds)


def batch_restaurant_ratings(m: Marketplace, as_of=None) -> DataFrame:
    return keep.ratings(review_feed(m), "restaurant_id")


def batch_partner_ratings(m: Marketplace, as_of=None) -> DataFrame:
    return keep.ratings(trip_rating_feed(m), "partner_id").drop("total_ratings")


def _audit(m: Marketplace) -> DataFrame:
    def take(stream: DataFrame, path: str, checkpoint: str) -> None:
        keep.run_available(stream, lambda batch, number: chain.fold(batch, number, path), checkpoint)

    return _replayed(m, status_events(m.source.raw("events")), take, lambda path: chain.read_log(m.spark, path))


def stream_audit_log(m: Marketplace, as_of=None) -> DataFrame:
    return _audit(m)


def batch_audit_log(m: Marketplace, as_of=None) -> DataFrame:
    return keep.audit_log(status_events(m.source.raw("events")))


def stream_first_status(m: Marketplace, as_of=None) -> DataFrame:
    return keep.first_status(_audit(m))


def batch_first_status(m: Marketplace, as_of=None) -> DataFrame:
    return keep.first_status(batch_audit_log(m))


def stream_live_monitor(m: Marketplace, as_of=None) -> DataFrame:
    with keep.passing_workspace(m.spark) as base:
        keep.fold_monitor(event_stream(m), f"{base}/state", f"{base}/cp")
        return cut(keep.ledger_monitor(m.spark, f"{base}/state"))


def batch_live_monitor(m: Marketplace, as_of=None) -> DataFrame:
    return keep.live_monitor(status_events(m.source.raw("events")))


def unassigned_orders(m: Marketplace, as_of=None) -> DataFrame:
    return keep.unassigned_orders(m)


def _windows(m: Marketplace, demand: keep.Demand) -> DataFrame:
    feed = status_events(m.source.raw("events"))
    return _replayed(m, feed, demand.fold, lambda path: demand.windows(m.spark, path)).drop("late")


def stream_hourly_demand(m: Marketplace, as_of=None, delay: str = keep.DELAY) -> DataFrame:
    return _windows(m, keep.Demand(delay=delay))


def stream_smoothed_demand(m: Marketplace, as_of=None, delay: str = keep.DELAY) -> DataFrame:
    return _windows(m, keep.Demand(times=3, delay=delay))


def batch_hourly_demand(m: Marketplace, as_of=None) -> DataFrame:
    return keep.demand_windows(status_events(m.source.raw("events")))


def batch_smoothed_demand(m: Marketplace, as_of=None) -> DataFrame:
    return keep.demand_windows(status_events(m.source.raw("events")), "3 hours", "1 hour")
