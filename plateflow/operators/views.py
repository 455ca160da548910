"""The detail view and the five summary views the other operators read."""

from __future__ import annotations

from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, functions as F

from plateflow.functions.dates import day_label, day_name, sunday_zero
from plateflow.functions.exact import count_where, percent, ratio
from plateflow.functions.ordering import Want, add_orders, asc, desc
from plateflow.functions.tiles import Tiles, add_tiles
from plateflow.model import Marketplace
from plateflow.operators.common import delivered, distinct, everything, is_cancelled, is_delivered


MONEY = "decimal(24,2)"


def materialised(dated: bool = False):
    """Read the stored copy of a view where the marketplace has one; a dated view must match the day."""

    def wrap(view):
        @wraps(view)
        def read(m: Marketplace, as_of: date | None = None, **parameters):
            kept = m.stored.get(view.__name__)
            if kept is None or (dated and kept[0] != as_of):
                return view(m, as_of, **parameters)
            if parameters.keys() - {"since"}:
                return view(m, as_of, **parameters)
            since = parameters.get("since")
            return kept[1] if since is None else kept[1].filter(F.col("day") >= F.lit(since))

        return read

    return wrap


def order_detail(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Every order with customer, restaurant, zone, delivery and review."""
    orders = m.orders(
        "order_id", "order_timestamp", "order_date", "order_status", "order_channel", "customer_id",
        "restaurant_id", "zone_id", "subtotal_amount", "discount_amount", "delivery_fee", "taxes", "total_amount",
        "platform_commission", "payment_method")
    homes = m.cities("city_id", "city_name").withColumnRenamed("city_name", "customer_city")
    people = m.customers("customer_id", "customer_name", "customer_tier", "city_id").join(homes, "city_id")
    people = people.drop("city_id")
    rests = m.restaurants("restaurant_id", "restaurant_name", "cuisine_type")
    zones = m.zones("zone_id", "zone_name")
    trips = m.deliveries("order_id", "partner_id", "actual_time_mins", "expected_time_mins", "distance_km",
                         "sla_breached", "on_time")
    partners = m.delivery_partners("partner_id", "partner_name")
    reviews = m.reviews("order_id", "food_rating", "delivery_rating", "overall_rating")
    # Orders without a delivery have no partner: their names are joined to the deliveries, not to the orders.
    trips = trips.join(partners, "partner_id", "left")
    # Large partitions of hot customers and restaurants are split when the plan runs.
    df = (
        orders.join(people, "customer_id").join(rests, "restaurant_id").join(zones, "zone_id", "left")
        .join(trips, "order_id", "left").join(reviews, "order_id", "left")
    )
    return df.select(
        "order_id", "order_timestamp", "order_date", "order_status", "order_channel", "customer_id",
        "customer_name", "customer_tier", "customer_city", "restaurant_id", "restaurant_name", "cuisine_type",
        "zone_name", "subtotal_amount", "discount_amount", "delivery_fee", "taxes", "total_amount",
        "platform_commission", "payment_method", "partner_id", "partner_name", "actual_time_mins",
        "expected_time_mins", "distance_km", "sla_breached", "on_time", "food_rating", "delivery_rating",
        "overall_rating")


@materialised()
def daily_kpi(m: Marketplace, as_of: date | None = None, since: date | None = None,
              approximate: bool = False) -> DataFrame:
    """One row per day. ``peak_start_hour`` is the hour of the first order of the day."""
    orders = m.orders("order_date", "order_timestamp", "order_status", "customer_id", "restaurant_id",
                      "total_amount", "platform_commission", "discount_amount", since=since)
    return daily_rows(orders.groupBy(F.col("order_date").alias("day")).agg(
        F.min("order_timestamp").alias("first_at"),
        F.count(F.lit(1)).alias("orders"),
        count_where(is_delivered()).alias("done"),
        count_where(is_cancelled()).alias("lost"),
        distinct("customer_id", approximate).alias("people"),
        distinct("restaurant_id", approximate).alias("places"),
        F.sum("total_amount").alias("gross"),
        F.sum("platform_commission").alias("platform"),
        F.sum("discount_amount").alias("discounts"),
        F.count("total_amount").alias("counted"),
    ))


def daily_rows(days: DataFrame) -> DataFrame:
    """The daily view from one row of figures per day."""
    c = F.col
    return days.select(
        "day", sunday_zero(c("day")).alias("day_of_week"), day_name(c("day")).alias("day_name"),
        F.hour("first_at").alias("peak_start_hour"), c("orders").alias("total_orders"), c("done").alias("delivered_orders"),
        c("lost").alias("cancelled_orders"), c("people").alias("active_customers"), c("places").alias("active_restaurants"),
        c("gross").cast(MONEY).alias("gross_revenue"), c("platform").cast(MONEY).alias("platform_revenue"),
        c("discounts").cast(MONEY).alias("discounts_given"), ratio(c("gross"), c("counted"), 2, num_scale=2).alias("avg_order_value"),
        percent(c("lost"), c("orders"), 2).alias("cancellation_rate_pct"))


@materialised()
def restaurant_performance(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """One row per restaurant with revenue ranks, overall and within its cuisine."""
    orders = m.orders("restaurant_id", "order_status", "total_amount", "platform_commission", "customer_id")
    sold = orders.filter(~is_cancelled()).groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("orders"),
        count_where(is_delivered()).alias("done"),
        F.sum("total_amount").alias("gross"),
        F.sum("platform_commission").alias("platform"),
        F.count("total_amount").alias("counted"),
        F.count_distinct("customer_id").alias("people"),
    )
    rated = m.reviews("restaurant_id", "food_rating", "overall_rating").groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum("food_rating").alias("food"), F.count("food_rating").alias("n_food"),
        F.sum("overall_rating").alias("overall"), F.count("overall_rating").alias("n_overall"),
    )
    return restaurant_rows(m, sold, rated)


def restaurant_rows(m: Marketplace, sold: DataFrame, rated: DataFrame) -> DataFrame:
    """The view of restaurants from their figures: of orders that were not cancelled, and of reviews."""
    c = F.col
    sold = sold.select(
        "restaurant_id", c("orders").alias("total_orders"), c("done").alias("delivered_orders"),
        c("gross").cast(MONEY).alias("gross_revenue"), c("platform").cast(MONEY).alias("platform_revenue"),
        ratio(c("gross"), c("counted"), 2, num_scale=2).alias("avg_order_value"), c("people").alias("unique_customers"))
    rated = rated.select(
        "restaurant_id", c("reviews").alias("review_count"), ratio(c("food"), c("n_food"), 2).alias("avg_food_rating"),
        ratio(c("overall"), c("n_overall"), 2).alias("avg_overall_rating"))
    rests = m.restaurants("restaurant_id", "restaurant_name", "cuisine_type", "city_id", "rating", "is_active",
                          "joining_date")
    df = (
        rests.join(m.cities("city_id", "city_name"), "city_id")
        .join(sold, "restaurant_id", "left").join(rated, "restaurant_id", "left")
    )
    best_first = (desc("gross_revenue", nulls_last=True),)
    df = add_orders(
        df, ["restaurant_id"],
        Want(best_first, rank="revenue_rank", rows="_n"),
        Want(best_first, partition=("cuisine_type",), rank="cuisine_revenue_rank"),
        Want((asc("gross_revenue"),), rank="_up"),
    )
    return df.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "city_name", "rating", "is_active", "joining_date",
        "total_orders", "delivered_orders", "gross_revenue", "platform_revenue", "avg_order_value",
        "unique_customers", "review_count", "avg_food_rating", "avg_overall_rating", "revenue_rank",
        "cuisine_revenue_rank", percent_rank("_up", "_n").alias("revenue_percentile"))


def percent_rank(rank: str, rows: str):
    """``percent_rank`` as a percentage with one digit; 0 for a single row."""
    return F.coalesce(percent(F.col(rank) - 1, F.col(rows) - 1, 1), F.lit(0).cast("decimal(24,1)"))


@materialised()
def hourly_demand(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Weekday by hour, against the total and against the average cell."""
    orders = m.orders("order_timestamp", "order_status", "total_amount").filter(~is_cancelled())
    ts = F.col("order_timestamp")
    return demand_rows(orders.groupBy(sunday_zero(ts).alias("day_of_week"), F.hour(ts).alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("amount"), F.count("total_amount").alias("counted")))


def demand_rows(cells: DataFrame) -> DataFrame:
    """The demand view from orders and money per cell."""
    c = F.col
    total, count = F.sum("orders").over(everything()), F.count(F.lit(1)).over(everything())
    return cells.withColumns({"_sum": total, "_cells": count}).select(
        "day_of_week", day_label(c("day_of_week")).alias("day_name"), "hour_of_day", c("orders").alias("order_count"),
        ratio(c("amount"), c("counted"), 2, num_scale=2).alias("avg_order_value"), c("amount").cast(MONEY).alias("total_revenue"),
        percent(c("orders"), c("_sum"), 3).alias("pct_of_total"),
        ratio(c("orders") * c("_cells"), c("_sum"), 3).alias("demand_index"))


@materialised()
def partner_performance(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """One row per active partner; partners without deliveries are kept."""
    trips = m.deliveries("partner_id", "delivery_id", "delivery_status", "actual_time_mins", "distance_km",
                         "partner_earnings", "sla_breached", "on_time").filter(F.col("partner_id").isNotNull())
    done = trips.groupBy("partner_id").agg(
        F.count("delivery_id").alias("trips"),
        count_where(F.col("delivery_status") == "Delivered").alias("done"),
        F.sum("actual_time_mins").alias("mins"), F.count("actual_time_mins").alias("n_mins"),
        F.sum("distance_km").alias("km"), F.count("distance_km").alias("n_km"),
        F.sum("partner_earnings").alias("earned"),
        count_where(F.col("sla_breached")).alias("late"),
        count_where(F.col("on_time")).alias("timely"),
    )
    return partner_rows(m, done)


def partner_rows(m: Marketplace, done: DataFrame) -> DataFrame:
    """The view of partners from the figures of their deliveries."""
    c = F.col
    done = done.select(
        "partner_id", c("trips").alias("_n"), c("done").alias("_done"), ratio(c("mins"), c("n_mins"), 1).alias("avg_delivery_time"),
        ratio(c("km"), c("n_km"), 2, num_scale=2).alias("avg_distance_km"), c("earned").cast(MONEY).alias("total_earnings"),
        c("late").alias("_late"), c("timely").alias("_on_time"))
    partners = m.delivery_partners("partner_id", "partner_name", "vehicle_type", "city_id", "zone_id", "rating",
                                   "joining_date", "is_active").filter("is_active")
    zero = F.lit(0).cast("long")
    df = (
        partners.join(m.cities("city_id", "city_name"), "city_id")
        .join(m.zones("zone_id", "zone_name"), "zone_id", "left")
        .join(done, "partner_id", "left")
        .withColumns({
            "total_deliveries": F.coalesce("_n", zero), "completed_deliveries": F.coalesce("_done", zero),
            "sla_breaches": F.coalesce("_late", zero), "on_time_deliveries": F.coalesce("_on_time", zero),
        })
    )
    df = add_orders(
        df, ["partner_id"],
        Want((desc("total_deliveries"),), rank="delivery_count_rank"),
        Want((asc("total_deliveries"),), tiles=("performance_quartile", 4)),
    )
    return df.select(
        "partner_id", "partner_name", "vehicle_type", "city_name", "zone_name",
        F.col("rating").alias("partner_rating"), "joining_date", "total_deliveries", "completed_deliveries",
        "avg_delivery_time", "avg_distance_km", "total_earnings", "sla_breaches", "on_time_deliveries",
        percent(F.col("on_time_deliveries"), F.col("completed_deliveries"), 1).alias("on_time_rate_pct"),
        "delivery_count_rank", "performance_quartile")


# Ordered rules (r, f, m as column -> bool); the first that holds names the segment.
def _segment(dictionary: bool):
    r, f, mon = F.col("r_score"), F.col("f_score"), F.col("m_score")
    rules = [
        ("Champions", (r >= 4) & (f >= 4) & (mon >= 4)),
        ("Loyal", (r >= 3) & (f >= 3)),
        ("Promising", (r >= 4) & (f <= 2)),
        ("New Customer", (r == 5) & (f == 1)),
        ("At Risk", (r <= 2) & (f >= 4)),
        ("Lost", (r == 1) & (f == 1)),
    ]
    if dictionary:
        # The published definitions: the narrow rules come before the wide ones that would hide them.
        rules = [rules[0], rules[1], rules[3], rules[2], rules[4], rules[5], ("Hibernating", (r <= 3) & (f <= 2))]
    out = None
    for name, holds in rules:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out.otherwise("Needs Attention")


@materialised(dated=True)
def customer_rfm(m: Marketplace, as_of: date, bands: int = 5, dictionary: bool = False) -> DataFrame:
    """Recency, frequency and money scores of customers with a delivered order."""
    base = delivered(m, "customer_id", "order_id", "order_date", "total_amount").groupBy("customer_id").agg(
        F.max("order_date").alias("last"), F.count("order_id").alias("orders"), F.sum("total_amount").alias("amount"))
    return rfm_rows(m, base, as_of, bands, dictionary)


def rfm_rows(m: Marketplace, spend: DataFrame, as_of: date, bands: int = 5, dictionary: bool = False) -> DataFrame:
    """Scores from the last day, number and sum of every customer's delivered orders."""
    base = spend.select("customer_id", F.datediff(F.lit(as_of), F.col("last")).alias("recency_days"),
                        F.col("orders").alias("frequency"), F.col("amount").cast(MONEY).alias("monetary"))
    scored = add_tiles(
        base, "customer_id", Tiles(desc("recency_days"), "r_score", bands), Tiles(asc("frequency"), "f_score", bands),
        Tiles(asc("monetary"), "m_score", bands))
    return scored.join(m.customers("customer_id", "customer_name", "customer_tier"), "customer_id").select(
        "customer_id", "customer_name", "customer_tier", "recency_days", "frequency", "monetary", "r_score",
        "f_score", "m_score", (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
        _segment(dictionary).alias("rfm_segment"))
