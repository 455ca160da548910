"""Demand, tickets, promotions, funnel, city trends and refunds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window as W, functions as F

from plateflow.functions.dates import day_label, month_of, seconds_between, sunday_zero
from plateflow.functions.exact import attach, count_where, growth, half_up, mean, percent, ratio, sum_where
from plateflow.functions.ordering import asc, desc, ordered
from plateflow.functions.quantiles import percentiles, rounded
from plateflow.model import Marketplace
from plateflow.operators.common import delivered, everything, is_cancelled, is_delivered, trailing, upto, zone_names


@ordered(asc("day_of_week"), asc("hour"))
def demand_plan(m: Marketplace, as_of: date | None = None, late_night: bool = False) -> DataFrame:
    """Weekday by hour with smoothing, rush label and staffing advice.

    The published late-night rule (23 to 1) can never hold; ``late_night`` makes it work.
    """
    orders = m.orders("order_timestamp", "total_amount")
    ts = F.col("order_timestamp")
    cells = orders.groupBy(sunday_zero(ts).alias("day_of_week"), F.hour(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"),
        mean(F.col("total_amount"), 2, 2).alias("avg_order_value"))
    near = W.partitionBy("day_of_week").orderBy("hour").rowsBetween(-1, 1)
    w = everything()
    cells = cells.withColumns({
        "_near": ratio(F.sum("orders").over(near), F.count(F.lit(1)).over(near), 1),
        "_sum": F.sum("orders").over(w), "_cells": F.count(F.lit(1)).over(w)})
    hour, load = F.col("hour"), F.col("orders") * F.col("_cells") * 10
    night = (hour >= 23) | (hour <= 1) if late_night else hour.between(23, 1)
    period = (
        F.when(hour.between(12, 14), "Lunch Rush 🍱").when(hour.between(19, 22), "Dinner Rush 🍽️")
        .when(night, "Late Night 🌙").when(hour.between(7, 9), "Breakfast 🌅").otherwise("Off-Peak")
    )
    staff = (
        F.when(load > F.col("_sum") * 18, "Max staffing needed").when(load > F.col("_sum") * 13, "Increased staffing")
        .when(load > F.col("_sum") * 8, "Normal staffing").otherwise("Reduced staffing OK")
    )
    return cells.select(
        day_label(F.col("day_of_week")).alias("day_name"), "day_of_week", "hour",
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))
        .alias("hour_label"), "orders", half_up(F.col("_near"), 0).alias("smoothed_orders"), "avg_order_value",
        percent(F.col("orders") * F.col("_cells"), F.col("_sum"), 1).alias("demand_index"),
        period.alias("time_period"), staff.alias("staffing_recommendation"))


def ticket_service(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Volume, breaches and resolution hours by issue and priority, critical first."""
    secs = seconds_between(F.col("created_at"), F.col("resolved_at"))
    df = m.support_tickets("issue_type", "priority", "status", "sla_breached", "created_at", "resolved_at").withColumn(
        "_secs", secs)
    n, late = F.count(F.lit(1)), count_where(F.col("sla_breached"))
    keys = ["issue_type", "priority"]
    rows = df.groupBy(*keys).agg(
        n.alias("total_tickets"), count_where(F.col("status") == "Resolved").alias("resolved"),
        count_where(F.col("status").isin("Open", "In Progress")).alias("open_tickets"), late.alias("sla_breaches"),
        percent(late, n, 1).alias("sla_breach_pct"),
        ratio(F.sum("_secs"), F.count("_secs") * 3600, 1, num_scale=6).alias("avg_resolution_hrs"))
    # Microseconds span far more values than minutes, hence the wide buckets.
    p90 = percentiles(df.withColumn("_micros", (F.col("_secs") * 1_000_000).cast("long")), keys, "_micros", [90],
                      width=1 << 26)
    p90 = p90.select(*keys, rounded(F.col("p90"), 1, scale=6, unit=3600).alias("p90_resolution_hrs"))
    order = (
        F.when(F.col("priority") == "Critical", 1).when(F.col("priority") == "High", 2)
        .when(F.col("priority") == "Medium", 3).otherwise(4)
    )
    return rows.join(p90, keys, "left").orderBy(order, F.desc("total_tickets"), "issue_type").select(
        *keys, "total_tickets", "resolved", "open_tickets", "sla_breaches", "sla_breach_pct", "avg_resolution_hrs",
        "p90_resolution_hrs")


@ordered(desc("net_platform_gain"), asc("promo_code"))
def promotion_effect(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Promotions against orders without one; both come from a single pass over the orders."""
    per = delivered(m, "promotion_id", "total_amount", "discount_amount", "platform_commission").groupBy(
        "promotion_id").agg(
        F.count(F.lit(1)).alias("promo_orders"), mean(F.col("total_amount"), 2, 2).alias("avg_order_value"),
        mean(F.col("discount_amount"), 2, 2).alias("avg_discount"), F.sum("total_amount").alias("total_gmv"),
        F.sum("discount_amount").alias("total_discount_cost"), F.sum("platform_commission").alias("total_commission"))
    base = per.filter("promotion_id is null").agg(F.max("avg_order_value").alias("baseline_aov"))
    promos = m.promotions("promotion_id", "promo_code", "promo_name", "promo_type", "discount_value")
    rows = attach(per.join(promos, "promotion_id"), base)
    gain = F.col("total_commission") - F.col("total_discount_cost")
    return rows.select(
        "promo_code", "promo_name", "promo_type", "discount_value", "promo_orders", "avg_order_value",
        "baseline_aov", half_up(F.col("avg_order_value") - F.col("baseline_aov"), 2).alias("aov_lift"),
        "avg_discount", "total_gmv", "total_discount_cost", "total_commission", gain.alias("net_platform_gain"),
        percent(gain, F.col("total_discount_cost"), 1, num_scale=2, den_scale=2).alias("promotion_roi_pct"))


@ordered(desc("orders"))
def order_funnel(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Orders reaching each stage, from one scan."""
    orders = m.orders("order_status", "confirmed_at", "prepared_at", "picked_up_at")
    stages = (
        ("Placed", F.count(F.lit(1))), ("Not Cancelled", count_where(~is_cancelled())),
        ("Confirmed", F.count("confirmed_at")), ("Prepared", F.count("prepared_at")),
        ("Picked Up", F.count("picked_up_at")), ("Delivered", count_where(is_delivered())),
    )
    one = orders.agg(*[c.alias(name) for name, c in stages])
    rows = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(f"`{name}`").alias("orders")) for name, _ in stages])
    out = one.select(F.explode(rows).alias("s"), F.col("Placed").alias("_all"))
    return out.select("s.stage", "s.orders", percent(F.col("s.orders"), F.col("_all"), 1).alias("conversion_pct"))


@ordered(asc("city_name"), desc("month"))
def city_monthly_revenue(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Revenue per city and month with growth, running total and three-month average.

    Orders are summed per customer and month before they meet the customers' cities, so
    distinct customers become a plain count and a busy customer is one row.
    """
    per = delivered(m, "customer_id", "order_date", "total_amount").groupBy(
        "customer_id", month_of(F.col("order_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_rev"))
    homes = m.customers("customer_id", "city_id")
    rows = per.join(homes, "customer_id").groupBy("city_id", "month").agg(
        F.sum("_n").alias("orders"), F.sum("_rev").cast("decimal(30,2)").alias("revenue"),
        F.count(F.lit(1)).alias("active_customers"))
    city = W.partitionBy("city_id")
    last3 = trailing("month", 2, city)
    rows = rows.join(m.cities("city_id", "city_name"), "city_id").withColumns({
        "aov": ratio(F.col("revenue"), F.col("orders"), 2, num_scale=2),
        "prev_month": F.lag("revenue").over(city.orderBy("month")),
        "cumulative_revenue": F.sum("revenue").over(upto("month", city)),
        "ma_3month": ratio(F.sum("revenue").over(last3), F.count("revenue").over(last3), 2, num_scale=2)})
    return rows.select(
        "city_name", "month", "orders", "revenue", "active_customers", "aov", "prev_month",
        growth(F.col("revenue"), F.col("prev_month"), 1, 2).alias("mom_growth_pct"), "cumulative_revenue", "ma_3month")


@ordered(desc("month"))
def refund_leakage(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Refunds, cancellations and discounts per month."""
    orders = m.orders("order_date", "order_status", "is_refunded", "refund_amount", "total_amount", "discount_amount")
    back, n, lost = F.col("is_refunded"), F.count(F.lit(1)), count_where(is_cancelled())
    total, cents = F.sum("total_amount"), {"num_scale": 2, "den_scale": 2}
    refunds, discounts = sum_where(back, F.col("refund_amount")), F.sum("discount_amount")
    return orders.groupBy(month_of(F.col("order_date")).alias("month")).agg(
        count_where(back).alias("refunded_orders"), refunds.alias("total_refunds"), total.alias("gross_revenue"),
        percent(refunds, total, 2, **cents).alias("refund_rate_pct"), lost.alias("cancellations"),
        percent(lost, n, 2).alias("cancellation_rate_pct"), discounts.alias("discount_cost"),
        percent(discounts, total, 2, **cents).alias("discount_rate_pct"))


@ordered(asc("issue_type"), desc("tickets"))
def tickets_by_status(m: Marketplace, as_of: date | None = None) -> DataFrame:
    rows = m.support_tickets("issue_type", "status").groupBy("issue_type", "status").agg(
        F.count(F.lit(1)).alias("tickets"))
    share = percent(F.col("tickets"), F.sum("tickets").over(W.partitionBy("issue_type")), 1)
    return rows.withColumn("pct_within_type", share)


@ordered(desc("friday_spike"), asc("zone_name"))
def friday_zones(m: Marketplace, as_of: date | None = None, dow: int = 5, ratio_percent: int = 130) -> DataFrame:
    """Zones whose orders on the given weekday exceed their weekday average."""
    days = delivered(m, "zone_id", "order_date").groupBy("zone_id", sunday_zero(F.col("order_date")).alias("_dow")).agg(
        F.count(F.lit(1)).alias("_n"))
    rows = days.groupBy("zone_id").agg(
        F.max(F.when(F.col("_dow") == dow, F.col("_n"))).alias("friday_orders"), F.sum("_n").alias("_sum"),
        F.count(F.lit(1)).alias("_days"))
    rows = rows.filter(F.col("friday_orders") * F.col("_days") * 100 > F.col("_sum") * ratio_percent)
    return rows.join(zone_names(m), "zone_id").select(
        "zone_name", "city_name", "friday_orders", ratio(F.col("_sum"), F.col("_days"), 0).alias("avg_daily_orders"),
        ratio(F.col("friday_orders") * F.col("_days"), F.col("_sum"), 2).alias("friday_spike"))


@ordered(asc("city_name"), asc("dow"))
def order_values(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Mean and exact percentiles of order value by city and weekday."""
    # Equal amounts of a customer on a weekday are one row before the join, whatever their number.
    amounts = delivered(m, "customer_id", "order_date", "total_amount").groupBy(
        "customer_id", sunday_zero(F.col("order_date")).alias("dow"), (F.col("total_amount") * 100).cast("long").alias("_c")
    ).agg(F.count(F.lit(1)).alias("_times"))
    homes = m.customers("customer_id", "city_id").join(m.cities("city_id", "city_name"), "city_id").drop("city_id")
    keys = ["city_name", "dow"]
    # Counting equal amounts once serves the mean as well as the percentiles.
    out = percentiles(amounts.join(homes, "customer_id"), keys, "_c", [50, 75, 90], weight="_times")
    return out.select(
        "city_name", "dow", day_label(F.col("dow")).alias("day_name"), F.col("n").alias("orders"),
        ratio(F.col("total"), F.col("n") * 100, 2).alias("mean_aov"),
        rounded(F.col("p50"), 2, scale=2).alias("median_aov"), rounded(F.col("p75"), 2, scale=2).alias("p75_aov"),
        rounded(F.col("p90"), 2, scale=2).alias("p90_aov"))
