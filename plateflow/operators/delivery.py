"""Delivery times, service levels, partners and zones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window as W, functions as F

from plateflow.functions.dates import day_label, days_before, seconds_between, sunday_zero
from plateflow.functions.exact import count_where, half_up, mean, percent, ratio
from plateflow.functions.ordering import asc, desc, ordered, top
from plateflow.functions.quantiles import histogram
from plateflow.model import Marketplace
from plateflow.operators.common import everything, is_cancelled, minutes_at, minutes_at_all, zone_names
from plateflow.operators.views import partner_performance


def done_trips(m: Marketplace, *columns: str, **bounds: date | None) -> DataFrame:
    """Completed deliveries; bounds as of ``Marketplace.table``."""
    return m.deliveries(*dict.fromkeys((*columns, "delivery_status")), **bounds).filter(
        F.col("delivery_status") == "Delivered")


def whole(value, places: int = 0):
    """A percentile of whole minutes as a rounded decimal."""
    return F.round(value, places).cast(f"decimal(20,{places})")


def delivery_times(m: Marketplace, as_of: date | None = None, approximate: bool = False) -> DataFrame:
    """Mean, percentiles and service-level shares of completed deliveries, from stored counts where there are some."""
    points = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    kept = None if approximate else m.stored.get("delivery_minutes")
    if kept is not None:
        counts, mins, marks = kept[1], F.col("mins"), ", ".join(map(str, points.values()))
        n, total = F.sum("trips"), F.sum(mins * F.col("trips"))
        late, timely = (F.coalesce(F.sum(F.when(F.col(c), F.col("trips"))), F.lit(0)) for c in ("late", "timely"))
        marks = F.expr(f"percentile(mins, array({marks}), trips)")
    else:
        counts, mins = done_trips(m, "actual_time_mins", "sla_breached", "on_time"), F.col("actual_time_mins")
        counts = counts.filter("actual_time_mins is not null")
        n, total = F.count(F.lit(1)), F.sum(mins)
        late, timely = count_where(F.col("sla_breached")), count_where(F.col("on_time"))
        marks = minutes_at_all("actual_time_mins", [*points.values()], approximate)
    found = counts.agg(
        marks.alias("_marks"), ratio(total, n, 1).alias("mean_mins"),
        F.coalesce(n, F.lit(0)).alias("total_deliveries"), late.alias("sla_breaches"), percent(late, n, 2).alias("sla_breach_pct"),
        timely.alias("on_time_count"), percent(timely, n, 2).alias("on_time_rate_pct"))
    marks = [whole(F.col("_marks")[i]).alias(f"{name}_mins") for i, name in enumerate(points)]
    return found.select("mean_mins", *marks, "total_deliveries", "sla_breaches", "sla_breach_pct", "on_time_count",
                        "on_time_rate_pct")


@ordered(asc("day_num"), asc("hour"))
def delivery_heatmap(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Weekday by hour: volume, minutes, breaches and congestion against the average cell."""
    trips = done_trips(m, "order_id", "delivery_id", "actual_time_mins", "sla_breached").filter(
        "actual_time_mins is not null")
    df = trips.join(m.orders("order_id", "order_timestamp"), "order_id")
    ts = F.col("order_timestamp")
    n, late = F.count(F.lit(1)), count_where(F.col("sla_breached"))
    cells = df.groupBy(sunday_zero(ts).alias("day_num"), F.hour(ts).alias("hour")).agg(
        F.count("delivery_id").alias("deliveries"),
        mean(F.col("actual_time_mins"), 1).alias("avg_delivery_mins"),
        whole(minutes_at("actual_time_mins", 0.5)).alias("median_delivery_mins"),
        late.alias("sla_breaches"), percent(late, n, 1).alias("sla_breach_pct"),
        mean(F.col("actual_time_mins"), 10).alias("_avg"),
    )
    w = everything()
    cells = cells.withColumns({"_total": F.sum("_avg").over(w), "_cells": F.count(F.lit(1)).over(w)})
    return cells.select(
        day_label(F.col("day_num")).alias("day_name"), "day_num", "hour", "deliveries",
        "avg_delivery_mins", "median_delivery_mins", "sla_breaches",
        "sla_breach_pct", ratio(F.col("_avg") * F.col("_cells"), F.col("_total"), 3, num_scale=10, den_scale=10)
        .alias("congestion_index"))


# Labels of the four performance quartiles, best first.
PARTNER_TIERS = ("🌟 Top Performer", "✅ Good", "📊 Average", "⚠️  Needs Coaching")


@ordered(desc("performance_score", nulls_last=True), asc("partner_id"))
def partner_scores(m: Marketplace, as_of: date | None = None, k: int | None = 100,
                   corrected: bool = False) -> DataFrame:
    """Composite score of rating, punctuality, experience and speed.

    Published, the rating weighs 20 points per star; ``corrected`` keeps it within 20.
    """
    df = partner_performance(m, as_of)
    zero = F.lit(0).cast("decimal(10,3)")
    quartile = F.col("performance_quartile")
    score = (
        F.coalesce("partner_rating", F.lit(0)) * (4 if corrected else 20)
        + F.coalesce("on_time_rate_pct", F.lit(0)) * F.expr("0.3")
        + F.least(F.expr("25.000"), (F.col("total_deliveries").cast("decimal(20,0)") * F.expr("0.025")))
        + F.greatest(zero, F.lit(25) - F.coalesce("avg_delivery_time", F.lit(40)))
    )
    tier = (
        F.when(quartile == 4, PARTNER_TIERS[0]).when(quartile == 3, PARTNER_TIERS[1])
        .when(quartile == 2, PARTNER_TIERS[2]).otherwise(PARTNER_TIERS[3])
    )
    df = df.withColumns({"performance_score": half_up(score, 1), "performance_tier": tier})
    return top(df, k, desc("performance_score", nulls_last=True), asc("partner_id")).select(
        "partner_id", "partner_name", "vehicle_type", "city_name", "zone_name", "partner_rating",
        "total_deliveries", "completed_deliveries", "avg_delivery_time", "avg_distance_km", "total_earnings",
        "on_time_rate_pct", "sla_breaches", "delivery_count_rank", "performance_quartile", "performance_score",
        "performance_tier")


# Risk labels of a zone, worst first.
ZONE_RISKS = ("🚨 High Risk — Increase partner supply", "⚠️  Medium Risk — Monitor closely", "✅ On Target")


@ordered(desc("sla_breach_pct"))
def zone_risk(m: Marketplace, as_of: date | None = None, min_deliveries: int = 100,
              corrected: bool = False) -> DataFrame:
    """Service level, target gap and partner density per zone.

    The published breach share divides by all orders of the zone, delivered or not;
    ``corrected`` divides by its deliveries.
    """
    trips = done_trips(m, "order_id", "delivery_id", "partner_id", "actual_time_mins", "sla_breached")
    df = m.orders("order_id", "zone_id").join(trips, "order_id", "left")
    late, n = count_where(F.col("sla_breached")), F.count("delivery_id" if corrected else F.lit(1))
    zones = df.groupBy("zone_id").agg(
        F.count("delivery_id").alias("total_deliveries"),
        F.count_distinct("partner_id").alias("active_partners"),
        mean(F.col("actual_time_mins"), 1).alias("actual_avg_time"),
        whole(minutes_at("actual_time_mins", 0.9)).alias("p90_time"),
        percent(late, n, 1).alias("sla_breach_pct"),
    ).filter(F.col("total_deliveries") > min_deliveries)
    df = zones.join(zone_names(m, "avg_delivery_time_mins"), "zone_id")
    target, avg, pct = F.col("avg_delivery_time_mins"), F.col("actual_avg_time"), F.col("sla_breach_pct")
    risk = (
        F.when((pct > 20) | (avg * 10 > target * 15), ZONE_RISKS[0])
        .when((pct > 10) | (avg * 10 > target * 12), ZONE_RISKS[1]).otherwise(ZONE_RISKS[2])
    )
    return df.select(
        "zone_name", "city_name", target.alias("target_time"), "total_deliveries", "active_partners",
        "actual_avg_time", "p90_time", "sla_breach_pct",
        half_up(avg - target, 1).alias("time_vs_target_mins"), risk.alias("zone_risk"),
        ratio(F.col("total_deliveries"), F.col("active_partners"), 1).alias("deliveries_per_partner"))


@ordered(desc("cancellations"), asc("cancellation_reason"))
def cancellation_reasons(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Why orders were cancelled, what was lost, how soon and at which hour."""
    orders = m.orders("cancellation_reason", "order_status", "total_amount", "cancelled_at", "order_timestamp")
    orders = orders.filter(is_cancelled() & F.col("cancellation_reason").isNotNull())
    hours = orders.groupBy("cancellation_reason", F.hour("order_timestamp").alias("_hour")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_lost"),
        F.sum(seconds_between(F.col("order_timestamp"), F.col("cancelled_at"))).alias("_secs"),
        F.count("cancelled_at").alias("_timed"))
    rows = hours.groupBy("cancellation_reason").agg(
        F.sum("_n").alias("cancellations"), F.sum("_lost").alias("total_gmv_lost"), F.sum("_secs").alias("_secs"),
        F.sum("_timed").alias("_timed"),
        F.max_by("_hour", F.struct(F.col("_n"), -F.col("_hour"))).alias("most_common_cancel_hour"))
    rows = rows.withColumn("_all", F.sum("cancellations").over(everything()))
    return rows.select(
        "cancellation_reason", "cancellations",
        percent(F.col("cancellations"), F.col("_all"), 2).alias("pct_of_cancellations"),
        ratio(F.col("total_gmv_lost"), F.col("cancellations"), 2, num_scale=2).alias("avg_order_value_lost"),
        "total_gmv_lost",
        ratio(F.col("_secs"), F.col("_timed") * 60, 1, num_scale=6).alias("avg_mins_before_cancel"),
        "most_common_cancel_hour")


def partner_days(m: Marketplace) -> DataFrame:
    """Completed deliveries per partner and order day."""
    trips = done_trips(m, "order_id", "partner_id", "partner_earnings", "distance_km", "actual_time_mins")
    return trips.join(m.orders("order_id", "order_date"), "order_id").groupBy("partner_id", "order_date").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("partner_earnings").alias("earned"),
        F.sum("distance_km").alias("km"), mean(F.col("actual_time_mins"), 10).alias("avg_time"))


@ordered(desc("total_earnings"), asc("partner_id"))
def partner_earnings(m: Marketplace, as_of: date | None = None, util: int = 8, k: int = 50) -> DataFrame:
    """Earnings and utilisation of active partners over their working days."""
    n = F.count(F.lit(1))
    rows = partner_days(m).groupBy("partner_id").agg(
        n.alias("working_days"),
        mean(F.col("trips"), 1).alias("avg_deliveries_per_day"),
        F.sum("earned").alias("total_earnings"),
        mean(F.col("earned").cast("decimal(20,2)"), 2, 2).alias("avg_daily_earnings"),
        half_up(F.sum("km"), 1).alias("total_km"),
        mean(F.col("avg_time"), 1, 10).alias("avg_delivery_time"),
        percent(count_where(F.col("trips") >= util), n, 1).alias("high_util_days_pct"),
    )
    partners = m.delivery_partners("partner_id", "partner_name", "vehicle_type", "city_id", "is_active").filter(
        "is_active").join(m.cities("city_id", "city_name"), "city_id")
    return top(rows.join(partners, "partner_id"), k, desc("total_earnings"), asc("partner_id")).select(
        "partner_id", "partner_name", "vehicle_type", "city_name", "working_days", "avg_deliveries_per_day",
        "total_earnings", "avg_daily_earnings", "total_km", "avg_delivery_time", "high_util_days_pct")


def zone_performance(m: Marketplace, as_of: date, start: date | None = None, end: date | None = None) -> DataFrame:
    """Completed deliveries per zone for orders placed from ``start`` to ``end`` (30 days by default)."""
    bounds = {"since": start or days_before(as_of, 30), "until": days_before(end or as_of, -1)}
    orders = m.orders("order_id", "zone_id", "order_date", **bounds).drop("order_date")
    trips = done_trips(m, "order_id", "actual_time_mins", "sla_breached", "on_time", "distance_km",
                       "partner_earnings", **bounds)
    df = orders.join(trips, "order_id").join(zone_names(m), "zone_id")
    n = F.count(F.lit(1))
    return df.groupBy("zone_name", "city_name").agg(
        n.alias("total_deliveries"),
        mean(F.col("actual_time_mins"), 1).alias("avg_time_mins"),
        whole(minutes_at("actual_time_mins", 0.5), 1).alias("median_time_mins"),
        percent(count_where(F.col("sla_breached")), n, 1).alias("sla_breach_pct"),
        percent(count_where(F.col("on_time")), n, 1).alias("on_time_pct"),
        mean(F.col("distance_km"), 2, 2).alias("avg_distance_km"),
        F.sum("partner_earnings").alias("total_earnings"))


@ordered(desc("mins_above_zone_avg"), asc("partner_name"))
def slow_partners(m: Marketplace, as_of: date | None = None, min_deliveries: int = 20,
                  ratio_percent: int = 130) -> DataFrame:
    """Partners whose average exceeds their zone's by the given percentage."""
    trips = done_trips(m, "order_id", "partner_id", "actual_time_mins")
    pairs = trips.join(m.orders("order_id", "zone_id"), "order_id").groupBy("partner_id", "zone_id").agg(
        F.count(F.lit(1)).alias("deliveries"), F.count("actual_time_mins").alias("_n"),
        F.sum("actual_time_mins").alias("_sum"))
    zone = pairs.groupBy("zone_id").agg(F.sum("_n").alias("_zn"), F.sum("_sum").alias("_zsum"))
    wide = "decimal(38,0)"
    df = pairs.filter(F.col("deliveries") >= min_deliveries).join(zone, "zone_id")
    mine = F.col("_sum").cast(wide) * F.col("_zn").cast("decimal(18,0)")
    theirs = F.col("_zsum").cast(wide) * F.col("_n").cast("decimal(18,0)")
    df = df.filter(mine * 100 > theirs * ratio_percent)
    partners = m.delivery_partners("partner_id", "partner_name", "vehicle_type")
    return df.join(partners, "partner_id").join(m.zones("zone_id", "zone_name"), "zone_id").select(
        "partner_name", "vehicle_type", "zone_name",
        ratio(F.col("_sum"), F.col("_n"), 1).alias("partner_avg_mins"),
        ratio(F.col("_zsum"), F.col("_zn"), 1).alias("zone_avg_mins"),
        ratio(mine - theirs, F.col("_n") * F.col("_zn"), 1).alias("mins_above_zone_avg"), "deliveries")


def inactive_partners(m: Marketplace, as_of: date, risk: int = 30, churn: int = 60) -> DataFrame:
    """Active partners without a delivery in the last ``risk`` days, or ever."""
    last = done_trips(m, "partner_id", "delivered_at").groupBy("partner_id").agg(
        F.max("delivered_at").cast("date").alias("last_active_date"))
    partners = m.delivery_partners("partner_id", "partner_name", "vehicle_type", "city_id", "joining_date",
                                   "total_deliveries", "is_active").filter("is_active")
    df = partners.join(m.cities("city_id", "city_name"), "city_id").join(last, "partner_id", "left")
    df = df.withColumn("days_inactive", F.datediff(F.lit(as_of), F.col("last_active_date")))
    idle = F.col("days_inactive")
    status = F.when(idle > churn, "Churned").when(idle > risk, "At Risk").otherwise("Active")
    df = df.filter((idle > risk) | idle.isNull()).withColumn("partner_status", status)
    return df.orderBy(idle.desc_nulls_first(), "partner_id").select(
        "partner_name", "vehicle_type", "city_name", "joining_date", "last_active_date", "days_inactive",
        "total_deliveries", "partner_status")


@ordered(desc("avg_mins"), asc("zone_name"))
def slow_zones(m: Marketplace, as_of: date | None = None, k: int = 20) -> DataFrame:
    """Zones by average minutes, ranked within their city."""
    trips = done_trips(m, "order_id", "delivery_id", "actual_time_mins", "distance_km")
    zones = trips.join(m.orders("order_id", "zone_id"), "order_id").groupBy("zone_id").agg(
        mean(F.col("actual_time_mins"), 10).alias("_avg"), mean(F.col("actual_time_mins"), 1).alias("avg_mins"),
        mean(F.col("distance_km"), 2, 2).alias("avg_km"), F.count("delivery_id").alias("deliveries"))
    df = zones.join(zone_names(m), "zone_id").withColumn(
        "slow_rank", F.rank().over(W.partitionBy("city_name").orderBy(F.col("_avg").desc_nulls_first())))
    return top(df, k, desc("_avg"), asc("zone_id")).select(
        "zone_name", "city_name", "avg_mins", "avg_km", "deliveries", "slow_rank")


@ordered(desc("gmv_at_risk"))
def unassigned_risk(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Open orders without a delivery, and their value, per zone."""
    orders = m.orders("order_id", "zone_id", "order_status", "total_amount").filter(
        ~F.col("order_status").isin("Delivered", "Cancelled"))
    free = orders.join(m.deliveries("order_id"), "order_id", "left_anti").groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("unassigned_active_orders"), F.sum("total_amount").alias("gmv_at_risk"))
    named = free.join(zone_names(m), "zone_id", "left").groupBy("zone_name", "city_name").agg(
        F.sum("unassigned_active_orders").alias("unassigned_active_orders"),
        F.sum("gmv_at_risk").alias("gmv_at_risk"))
    return named.select("unassigned_active_orders", "gmv_at_risk", "zone_name", "city_name")


@ordered(desc("actual_time_mins"), asc("order_id"))
def late_orders(m: Marketplace, as_of: date | None = None, k: int = 20) -> DataFrame:
    """The slowest deliveries beyond the service level; only the ``k`` kept rows are looked up further."""
    trips = m.deliveries("order_id", "actual_time_mins", "expected_time_mins", "sla_breached").filter("sla_breached")
    kept = top(trips, k, desc("actual_time_mins"), asc("order_id"))
    df = kept.join(m.orders("order_id", "customer_id", "restaurant_id", "zone_id"), "order_id")
    df = df.join(m.customers("customer_id", "customer_name"), "customer_id")
    rests = m.restaurants("restaurant_id", "restaurant_name", "city_id").join(
        m.cities("city_id", "city_name"), "city_id")
    df = df.join(rests, "restaurant_id").join(m.zones("zone_id", "zone_name"), "zone_id", "left")
    return df.select("order_id", "customer_name", "restaurant_name", "city_name", "zone_name", "actual_time_mins",
                     "expected_time_mins",
                     (F.col("actual_time_mins") - F.col("expected_time_mins")).alias("overrun_mins"))


def time_percentiles(m: Marketplace, as_of: date | None = None, max_mins: int = 120,
                     points: tuple[int, ...] = (10, 25, 50, 75, 90, 95, 99)) -> DataFrame:
    """Seven percentiles, median and late share of deliveries below ``max_mins``."""
    trips = done_trips(m, "actual_time_mins").filter(F.col("actual_time_mins") < max_mins)
    n, late = F.count(F.lit(1)), count_where(F.col("actual_time_mins") > 45)
    found = trips.agg(minutes_at_all("actual_time_mins", [p / 100 for p in points]).alias("_marks"),
                      percent(late, n, 1).alias("late_pct"), n.alias("deliveries"))
    return found.select(*[whole(F.col("_marks")[i], 1).alias(f"p{p}") for i, p in enumerate(points)], "late_pct", "deliveries")


def time_histogram(m: Marketplace, as_of: date | None = None, max_mins: int = 120, bins: int = 50) -> DataFrame:
    trips = done_trips(m, "actual_time_mins").filter(F.col("actual_time_mins") < max_mins)
    return histogram(trips, "actual_time_mins", bins)


def zone_late_share(m: Marketplace, as_of: date | None = None, min_deliveries: int = 50, k: int = 20) -> DataFrame:
    """Zones with the highest late share."""
    trips = done_trips(m, "order_id", "actual_time_mins", "sla_breached")
    n = F.count(F.lit(1))
    zones = trips.join(m.orders("order_id", "zone_id"), "order_id").join(zone_names(m), "zone_id").groupBy(
        "zone_name", "city_name").agg(
        n.alias("deliveries"), mean(F.col("actual_time_mins"), 1).alias("avg_time"),
        percent(count_where(F.col("sla_breached")), n, 1).alias("sla_pct"))
    zones = zones.filter(F.col("deliveries") > min_deliveries)
    return top(zones, k, desc("sla_pct"), asc("zone_name"), asc("city_name"))


def partner_average(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Average minutes of every partner, with partners that never delivered."""
    avg = m.deliveries("partner_id", "actual_time_mins").groupBy("partner_id").agg(
        mean(F.col("actual_time_mins"), 6).alias("avg_time"))
    return m.delivery_partners("partner_id").join(avg, "partner_id", "left")


def quartile_by_vehicle(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Partners per quartile and vehicle with averages of their figures."""
    one = F.col("avg_delivery_time")
    return partner_performance(m, as_of).groupBy("performance_quartile", "vehicle_type").agg(
        F.count(F.lit(1)).alias("partners"), mean(one, 1, 1).alias("avg_mins"),
        mean(F.col("on_time_rate_pct"), 1, 1).alias("avg_on_time_pct"),
        mean(F.col("total_earnings"), 0, 2).alias("avg_earnings"))


def quartile_pivot(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """On-time share by quartile (rows) and vehicle (columns)."""
    rows = quartile_by_vehicle(m, as_of)
    kinds = ("Bicycle", "Car", "Motorbike", "Scooter")
    return rows.groupBy("performance_quartile").pivot("vehicle_type", list(kinds)).agg(F.max("avg_on_time_pct"))


def late_share(m: Marketplace, as_of: date | None = None) -> DataFrame:
    trips = done_trips(m, "sla_breached")
    return trips.agg(percent(count_where(F.col("sla_breached")), F.count(F.lit(1)), 1).alias("sla_breach_pct"))
