"""Stand-alone questions about orders and customers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from plateflow.functions.dates import day_label, days_before, first_of_month, month_of, shift_months, sunday_zero
from plateflow.functions.exact import count_where, mean, percent, ratio
from plateflow.functions.ordering import asc, desc, ordered, top
from plateflow.functions.skew import join_spread
from plateflow.model import Marketplace
from plateflow.operators.common import delivered, everything, is_cancelled
from plateflow.session import cut


@ordered(desc("order_count"), asc("city_name"))
def orders_per_city(m: Marketplace, as_of: date) -> DataFrame:
    """Orders of the previous calendar month by the customer's city."""
    start = first_of_month(as_of)
    per = m.orders("customer_id", since=shift_months(start, -1), until=start).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"))
    rows = per.join(m.customers("customer_id", "city_id"), "customer_id").join(m.cities("city_id", "city_name"), "city_id")
    return rows.groupBy("city_name").agg(F.sum("_n").alias("order_count"))


@ordered(desc("avg_order_value"))
def value_by_payment(m: Marketplace, as_of: date | None = None) -> DataFrame:
    return delivered(m, "payment_method", "total_amount").groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("orders"), mean(F.col("total_amount"), 2, 2).alias("avg_order_value"),
        F.sum("total_amount").alias("total_revenue"))


def never_ordered(m: Marketplace, as_of: date | None = None, until: date | None = None) -> DataFrame:
    """Customers without any order, or without one before ``until``, the latest registrations first."""
    people = m.customers("customer_id", "customer_name", "email", "registration_date")
    return people.join(m.orders("customer_id", until=until).distinct(), "customer_id", "left_anti").orderBy(
        F.desc("registration_date"), "customer_id")


def dormant(m: Marketplace, as_of: date, days: int = 365) -> DataFrame:
    """Customers without a delivered order in the last ``days``."""
    people = m.customers("customer_id", "customer_name", "email", "registration_date")
    seen = delivered(m, "customer_id", since=days_before(as_of, days)).distinct()
    return people.join(seen, "customer_id", "left_anti")


@ordered(asc("city_name"), desc("partner_count"))
def partners_by_vehicle(m: Marketplace, as_of: date | None = None) -> DataFrame:
    partners = m.delivery_partners("city_id", "vehicle_type", "is_active").join(
        m.cities("city_id", "city_name"), "city_id")
    return partners.groupBy("city_name", "vehicle_type").agg(
        F.count(F.lit(1)).alias("partner_count"), count_where(F.col("is_active")).alias("active_partners"))


def promotion_usage(m: Marketplace, as_of: date | None = None) -> DataFrame:
    used, n = F.count("promotion_id"), F.count(F.lit(1))
    return m.orders("promotion_id").agg(used.alias("promo_orders"), n.alias("total_orders"),
                                        percent(used, n, 2).alias("promo_usage_pct"))


@ordered(desc("order_count"), asc("hour"))
def orders_by_hour(m: Marketplace, as_of: date | None = None) -> DataFrame:
    orders = m.orders("order_timestamp", "order_status", "total_amount").filter(~is_cancelled())
    return orders.groupBy(F.hour("order_timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("order_count"), mean(F.col("total_amount"), 2, 2).alias("avg_order_value"))


@ordered(desc("spend_last_30d"), asc("customer_id"))
def big_spenders(m: Marketplace, as_of: date, days: int = 30, min_spend: int = 10000) -> DataFrame:
    rows = delivered(m, "customer_id", "total_amount", since=days_before(as_of, days)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders_last_30d"), F.sum("total_amount").alias("spend_last_30d"))
    rows = rows.filter(F.col("spend_last_30d") > min_spend)
    return rows.join(m.customers("customer_id", "customer_name", "customer_tier"), "customer_id").select(
        "customer_id", "customer_name", "customer_tier", "orders_last_30d", "spend_last_30d")


@ordered(desc("unique_cuisines_tried"), asc("customer_id"))
def food_explorers(m: Marketplace, as_of: date | None = None, min_cuisines: int = 5) -> DataFrame:
    """Customers who ordered from several cuisines."""
    pairs = delivered(m, "customer_id", "restaurant_id").groupBy("customer_id", "restaurant_id").agg(
        F.count(F.lit(1)).alias("_n"))
    kinds = m.restaurants("restaurant_id", "cuisine_type")
    rows = join_spread(pairs, kinds, "restaurant_id", "customer_id").groupBy("customer_id").agg(
        F.count_distinct("cuisine_type").alias("unique_cuisines_tried"),
        F.count(F.lit(1)).alias("unique_restaurants"), F.sum("_n").alias("total_orders"))
    rows = rows.filter(F.col("unique_cuisines_tried") >= min_cuisines)
    return rows.join(m.customers("customer_id", "customer_name", "customer_tier"), "customer_id").select(
        "customer_id", "customer_name", "customer_tier", "unique_cuisines_tried", "unique_restaurants", "total_orders")


@ordered(desc("total_deliveries"), asc("partner_name"))
def seasoned_partners(m: Marketplace, as_of: date | None = None, min_deliveries: int = 500,
                      min_rating: float = 4.5) -> DataFrame:
    partners = m.delivery_partners("partner_name", "vehicle_type", "city_id", "rating", "total_deliveries",
                                   "total_earnings")
    rows = partners.filter((F.col("total_deliveries") >= min_deliveries) & (F.col("rating") >= min_rating))
    return rows.join(m.cities("city_id", "city_name"), "city_id").select(
        "partner_name", "vehicle_type", "city_name", "rating", "total_deliveries", "total_earnings")


@ordered(desc("active_months"), asc("customer_id"))
def active_every_month(m: Marketplace, as_of: date, months: int = 6) -> DataFrame:
    """Customers with a delivered order in each of the last ``months`` calendar months."""
    start = shift_months(first_of_month(as_of), 1 - months)
    calendar = m.spark.range(1).select(F.explode(F.sequence(
        F.lit(start), F.lit(first_of_month(as_of)), F.expr("interval 1 month"))).alias("month"))
    seen = delivered(m, "customer_id", "order_date", since=start).select(
        "customer_id", month_of(F.col("order_date")).alias("month")).distinct()
    rows = seen.join(calendar, "month", "left_semi").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("active_months")).filter(F.col("active_months") == months)
    return rows.join(m.customers("customer_id", "customer_name", "customer_tier"), "customer_id").select(
        "customer_id", "customer_name", "customer_tier", "active_months")


@ordered(desc("above_avg_by"), asc("order_id"))
def above_own_average(m: Marketplace, as_of: date | None = None, ratio_percent: int = 150, k: int = 20) -> DataFrame:
    """Orders well above the customer's own average.

    The averages double as the count of orders per customer, so the join can spread a
    customer with very many orders over several tasks.
    """
    orders = delivered(m, "order_id", "customer_id", "total_amount")
    # The join looks at the averages twice; the orders behind them are read once.
    own = cut(orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("_sum")))
    df = join_spread(orders, own, "customer_id", "order_id", count_column="n")
    n = F.col("n").cast("decimal(12,0)")
    df = df.filter(F.col("total_amount") * n * 100 > F.col("_sum") * ratio_percent)
    df = df.withColumn("above_avg_by", ratio(
        (F.col("total_amount") * n - F.col("_sum")).cast("decimal(38,2)"), F.col("n"), 2, num_scale=2))
    kept = top(df, k, desc("above_avg_by"), asc("order_id"))
    return kept.join(m.customers("customer_id", "customer_name"), "customer_id").select(
        "order_id", "customer_name", F.col("total_amount").alias("this_order"),
        ratio(F.col("_sum"), F.col("n"), 6, num_scale=2).alias("customer_avg"), "above_avg_by")


def first_and_last(m: Marketplace, as_of: date | None = None, k: int | None = 20) -> DataFrame:
    """First and last delivered order of each customer and where they were placed."""
    orders = delivered(m, "customer_id", "order_id", "order_timestamp", "restaurant_id")
    at = F.struct("order_timestamp", "order_id")
    rows = orders.groupBy("customer_id").agg(
        F.min("order_timestamp").alias("first_order_time"), F.min_by("restaurant_id", at).alias("_first"),
        F.max("order_timestamp").alias("last_order_time"), F.max_by("restaurant_id", at).alias("_last"),
        F.count(F.lit(1)).alias("total_orders"))
    rows = top(rows, k, asc("customer_id")) if k is not None else rows
    names = m.restaurants("restaurant_id", "restaurant_name")
    for side in ("first", "last"):
        rows = rows.join(names.select(F.col("restaurant_id").alias(f"_{side}"),
                                      F.col("restaurant_name").alias(f"{side}_restaurant")), f"_{side}")
    return rows.join(m.customers("customer_id", "customer_name"), "customer_id").select(
        "customer_id", "customer_name", "first_order_time", "first_restaurant", "last_order_time",
        "last_restaurant", "total_orders")


@ordered(desc("improvement"), asc("customer_name"))
def more_in_second_quarter(m: Marketplace, as_of: date, q: tuple[int, int] = (1, 2), k: int = 20) -> DataFrame:
    """Customers with more orders in the later of two quarters of this year."""
    year = as_of.year
    quarter = F.quarter("order_date")
    first, last = date(year, 3 * min(q) - 2, 1), shift_months(date(year, 3 * max(q) - 2, 1), 3)
    rows = delivered(m, "customer_id", "order_date", since=first, until=last).groupBy("customer_id").agg(
        count_where(quarter == q[0]).alias("q1_orders"), count_where(quarter == q[1]).alias("q2_orders"))
    rows = rows.withColumn("improvement", F.col("q2_orders") - F.col("q1_orders")).filter("improvement > 0")
    kept = top(rows, k, desc("improvement"), asc("customer_id"))
    return kept.join(m.customers("customer_id", "customer_name", "customer_tier"), "customer_id").select(
        "customer_name", "customer_tier", "q1_orders", "q2_orders", "improvement")


def status_distribution(m: Marketplace, as_of: date | None = None) -> DataFrame:
    rows = m.orders("order_status").groupBy("order_status").agg(F.count(F.lit(1)).alias("count"))
    return rows.withColumn("pct", percent(F.col("count"), F.sum("count").over(everything()), 1))


def demand_by_day_name(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Demand by weekday name and hour over orders of every status."""
    ts = F.col("order_timestamp")
    cells = m.orders("order_timestamp", "total_amount").groupBy(
        sunday_zero(ts).alias("_dow"), F.hour(ts).alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("orders"), mean(F.col("total_amount"), 2, 2).alias("avg_order_value"))
    w = everything()
    cells = cells.withColumns({"_sum": F.sum("orders").over(w), "_cells": F.count(F.lit(1)).over(w)})
    return cells.select(
        day_label(F.col("_dow")).alias("day_name"), "hour_of_day", "orders", "avg_order_value",
        ratio(F.col("orders") * F.col("_cells"), F.col("_sum"), 2).alias("demand_index"))
