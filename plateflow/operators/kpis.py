"""Named indicators at any grain, and the figures behind the dashboards."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plateflow.functions.dates import days_before, first_of_month, month_of, seconds_between, shift_months
from plateflow.functions.exact import attach, count_where, growth, mean, percent, ratio, sum_where
from plateflow.functions.ordering import asc, desc, top
from plateflow.functions.quantiles import histogram, percentiles, rounded
from plateflow.model import TICKET_SLA_HOURS, Marketplace
from plateflow.operators.common import activity_months, delivered, is_cancelled, is_delivered, minutes_at, places, \
    zone_names
from plateflow.operators.customers import rfm_summary
from plateflow.operators.delivery import done_trips, partner_days, whole
from plateflow.operators.restaurants import health_scores, onboarding_ramp
from plateflow.operators.views import customer_rfm, daily_kpi, hourly_demand, partner_performance

CENTS = {"num_scale": 2, "den_scale": 2}
GRAINS = ("day", "week", "month", "quarter", "year")
BREAKDOWNS = ("city", "cuisine", "restaurant", "payment_method")


def _period(grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    return F.col("order_date") if grain == "day" else F.trunc("order_date", grain)


def revenue_metrics(m: Marketplace, as_of: date | None = None, by: Sequence[str] = (), grain: str | None = None,
                    since: date | None = None) -> DataFrame:
    """GMV, net and platform revenue, take rate, order value, discount and refund rates.

    ``by`` takes any of city, cuisine, restaurant and payment_method, ``grain`` a calendar
    unit. Orders are summed at the finest key first and meet the dimensions afterwards.
    """
    unknown = set(by) - set(BREAKDOWNS)
    if unknown:
        raise ValueError(f"unknown breakdown {sorted(unknown)}")
    keys: dict[str, Column] = {}
    columns = ["order_status", "total_amount", "platform_commission", "discount_amount", "refund_amount"]
    if grain:
        columns.append("order_date")
        keys["period"] = _period(grain)
    if "city" in by:
        keys["customer_id"] = F.col("customer_id")
    if set(by) & {"cuisine", "restaurant"}:
        keys["restaurant_id"] = F.col("restaurant_id")
    if "payment_method" in by:
        keys["payment_method"] = F.col("payment_method")
    columns += [k for k in keys if k != "period"]
    live = ~is_cancelled()
    sums = {
        "gmv": sum_where(live, F.col("total_amount")), "_refunds": sum_where(live, F.col("refund_amount")),
        "_all_refunds": F.sum("refund_amount"), "platform_revenue": sum_where(is_delivered(), F.col("platform_commission")),
        "_discounts": sum_where(live, F.col("discount_amount")), "delivered_orders": count_where(is_delivered()),
        "orders": F.count(F.lit(1)),
    }
    orders = m.orders(*columns, since=since)
    rows = orders.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*[c.alias(k) for k, c in sums.items()])
    if "city" in by:
        rows = rows.join(m.customers("customer_id", "city_id"), "customer_id").join(
            m.cities("city_id", "city_name"), "city_id").withColumnRenamed(
            "city_name", "city")
    if "restaurant_id" in keys:
        rests = m.restaurants("restaurant_id", "restaurant_name", "cuisine_type").withColumnsRenamed(
            {"restaurant_name": "restaurant", "cuisine_type": "cuisine"})
        rows = rows.join(rests, "restaurant_id")
    group = (["period"] if grain else []) + list(by)
    if set(keys) != set(group):
        if "restaurant" in by:
            group.append("restaurant_id")
        rows = rows.groupBy(*group).agg(*[F.sum(k).alias(k) for k in sums])
    c, zero = F.col, F.lit(0).cast("decimal(10,2)")
    gmv, refunds = F.coalesce(c("gmv"), zero), F.coalesce(c("_refunds"), zero)
    rows = rows.withColumn("net_revenue", gmv - refunds)
    return rows.select(
        *group, "orders", "delivered_orders", "gmv", "net_revenue", "platform_revenue",
        percent(c("platform_revenue"), c("gmv"), 2, **CENTS).alias("take_rate_pct"),
        ratio(c("net_revenue"), c("delivered_orders"), 2, num_scale=2).alias("aov"),
        percent(c("_discounts"), c("gmv"), 2, **CENTS).alias("discount_rate_pct"),
        percent(c("_all_refunds"), c("net_revenue"), 2, **CENTS).alias("refund_rate_pct"))


def revenue_year_to_date(m: Marketplace, as_of: date, by: Sequence[str] = ()) -> DataFrame:
    return revenue_metrics(m, as_of, by, since=date(as_of.year, 1, 1))


def customer_metrics(m: Marketplace, as_of: date, days: int = 30) -> DataFrame:
    """Monthly actives, month-1 retention, churn, average value and repeat rate."""
    active = m.orders("customer_id", since=days_before(as_of, days)).agg(F.count_distinct("customer_id").alias("mau"))
    months = activity_months(m)
    # The month-1 rate counts only cohorts whose following month is over.
    full = F.col("cohort") < F.lit(shift_months(first_of_month(as_of), -1))
    back = months.agg(
        count_where(full & (F.col("month_number") == 0)).alias("_size"),
        count_where(full & (F.col("month_number") == 1)).alias("_back"))
    spend = delivered(m, "customer_id", "total_amount").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").cast("decimal(24,2)").alias("_sum"))
    value = spend.agg(
        mean(F.col("_sum"), 2, 2).alias("avg_customer_ltv"),
        percent(count_where(F.col("_n") >= 2), F.count(F.lit(1)), 1).alias("repeat_purchase_rate_pct"))
    rows = attach(attach(active, back), value)
    return rows.select(
        "mau", percent(F.col("_back"), F.col("_size"), 1).alias("retention_m1_pct"),
        percent(F.col("_size") - F.col("_back"), F.col("_size"), 1).alias("churn_rate_pct"), "avg_customer_ltv",
        "repeat_purchase_rate_pct")


def acquisition_cost(m: Marketplace, spend: DataFrame) -> DataFrame:
    """Cost per new customer and value-to-cost ratio per channel; ``spend`` is (acquisition_channel, amount)."""
    value = delivered(m, "customer_id", "total_amount").groupBy("customer_id").agg(
        F.sum("total_amount").cast("decimal(24,2)").alias("_ltv"))
    rows = m.customers("customer_id", "acquisition_channel").join(value, "customer_id", "left").groupBy(
        "acquisition_channel").agg(F.count(F.lit(1)).alias("new_customers"), F.sum("_ltv").alias("_ltv"),
                                   F.count("_ltv").alias("_ordering"))
    rows = rows.join(spend, "acquisition_channel")
    paid = F.col("amount").cast("decimal(20,2)")
    return rows.select(
        "acquisition_channel", "new_customers", paid.alias("marketing_spend"),
        ratio(paid, F.col("new_customers"), 2, num_scale=2).alias("cac"),
        ratio(F.col("_ltv"), F.col("_ordering"), 2, num_scale=2).alias("avg_ltv"),
        ratio((F.col("_ltv") * F.col("new_customers").cast("decimal(12,0)")).cast("decimal(38,2)"),
              (paid * F.col("_ordering").cast("decimal(12,0)")).cast("decimal(38,2)"), 2, **CENTS).alias("ltv_to_cac"))


def acquisition_cost_flat(m: Marketplace, as_of: date | None = None, per_customer: int = 250) -> DataFrame:
    """The same with a flat spend per registered customer, where no spend table exists."""
    spend = m.customers("acquisition_channel").groupBy("acquisition_channel").agg(
        (F.count(F.lit(1)) * per_customer).alias("amount"))
    return acquisition_cost(m, spend)


def delivery_metrics(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Average and median minutes, late and on-time shares, trips per partner and day, cancellations."""
    n = F.count(F.lit(1))
    trips = done_trips(m, "actual_time_mins", "sla_breached", "on_time").agg(
        mean(F.col("actual_time_mins"), 1).alias("avg_delivery_mins"),
        whole(minutes_at("actual_time_mins", 0.5), 1).alias("median_delivery_mins"),
        percent(count_where(F.col("sla_breached")), n, 2).alias("sla_breach_rate_pct"),
        percent(count_where(F.col("on_time")), n, 2).alias("on_time_rate_pct"))
    use = partner_days(m).agg(ratio(F.sum("trips"), n, 2).alias("partner_utilisation"))
    lost = m.orders("order_status").agg(percent(count_where(is_cancelled()), n, 2).alias("cancellation_rate_pct"))
    return attach(attach(trips, use), lost)


def restaurant_metrics(m: Marketplace, as_of: date, days: int = 30) -> DataFrame:
    """Average food rating, activation in the last days, order value and days to 100 orders."""
    rating = m.reviews("food_rating").agg(mean(F.col("food_rating"), 2).alias("avg_food_rating"))
    live = m.orders("restaurant_id", since=days_before(as_of, days)).agg(F.count_distinct("restaurant_id").alias("_live"))
    total = m.restaurants("restaurant_id").agg(F.count(F.lit(1)).alias("_all"))
    orders = m.orders("order_status", "total_amount").filter(~is_cancelled()).agg(
        mean(F.col("total_amount"), 2, 2).alias("avg_order_value"))
    ramp = days_to_hundred(m)
    rows = attach(attach(attach(attach(rating, live), total), orders), ramp)
    return rows.select("avg_food_rating", percent(F.col("_live"), F.col("_all"), 1).alias("activation_rate_pct"),
                       "avg_order_value", "avg_days_to_100_orders")


def days_to_hundred(m: Marketplace, as_of: date | None = None) -> DataFrame:
    ramp = onboarding_ramp(m)
    return ramp.agg(mean(F.col("days_to_100_orders"), 1).alias("avg_days_to_100_orders"))


def ticket_sla(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Resolved tickets against the hours of their priority (low priority has no limit)."""
    limit = F.create_map(*[F.lit(x) for pair in TICKET_SLA_HOURS.items() for x in pair])
    secs = seconds_between(F.col("created_at"), F.col("resolved_at"))
    df = m.support_tickets("priority", "created_at", "resolved_at").withColumn("_secs", secs)
    df = df.withColumn("_limit", limit[F.col("priority")])
    late = F.col("_secs") > F.col("_limit") * 3600
    n = F.count("_secs")
    return df.groupBy("priority").agg(
        F.max("_limit").alias("sla_hours"), F.count(F.lit(1)).alias("tickets"), n.alias("resolved"),
        count_where(late).alias("breaches"), percent(count_where(late), n, 1).alias("breach_pct"))


def assignment_sla(m: Marketplace, as_of: date | None = None, target: int = 3, breach: int = 5) -> DataFrame:
    """Minutes from order to partner assignment against target and breach limits."""
    trips = m.deliveries("order_id", "assigned_at").join(m.orders("order_id", "order_timestamp"), "order_id")
    secs = seconds_between(F.col("order_timestamp"), F.col("assigned_at"))
    n, ok = F.count("_secs"), count_where(F.col("_secs") < target * 60)
    late = count_where(F.col("_secs") > breach * 60)
    return trips.withColumn("_secs", secs).agg(
        n.alias("assigned"), ratio(F.sum("_secs"), n * 60, 2, num_scale=6).alias("avg_assignment_mins"),
        ok.alias("within_target"), percent(ok, n, 1).alias("within_target_pct"), late.alias("breaches"),
        percent(late, n, 1).alias("breach_pct"))


def rfm_by_dictionary(m: Marketplace, as_of: date) -> DataFrame:
    """Segments by the published definitions, which include New Customer and Hibernating."""
    return customer_rfm(m, as_of, dictionary=True).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), mean(F.col("monetary"), 2, 2).alias("avg_ltv"),
        mean(F.col("recency_days"), 0).alias("avg_days_inactive"))


def month_to_date(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Running value within each month and its change against the same day of the month before.

    Where the month before is shorter, its last day is taken.
    """
    days = daily_kpi(m).select("day", "gross_revenue").withColumn("_month", month_of(F.col("day")))
    run = W.partitionBy("_month").orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    days = days.withColumn("mtd_gmv", F.sum("gross_revenue").over(run))
    # The last known running value on or before the shifted day, in that month.
    back = days.select(F.col("_month").alias("_bm"), F.col("day").alias("_bday"), F.col("mtd_gmv").alias("_bv"))
    now = days.withColumns({"_pm": F.add_months("_month", -1), "_pd": F.add_months("day", -1)})
    # At most 31 days meet 31 days per month.
    pairs = now.join(back, (F.col("_pm") == F.col("_bm")) & (F.col("_bday") <= F.col("_pd")), "left")
    rows = pairs.groupBy("day", "mtd_gmv").agg(F.max_by("_bv", "_bday").alias("prior_mtd_gmv"))
    change = F.coalesce(growth(F.col("mtd_gmv"), F.col("prior_mtd_gmv"), 2, 2), F.lit(0).cast("decimal(24,2)"))
    return rows.withColumn("mom_growth_pct", change)


# Colour bands of the dashboards.
DEMAND_COLORS = ((2.0, "#E74C3C"), (1.5, "#F39C12"), (None, "#27AE60"))
TIER_COLORS = {"Platinum": "#8E44AD", "Gold": "#F39C12", "Silver": "#95A5A6"}
OTHER_TIER = "#CD6155"


def late_share_of_partners(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Late deliveries over deliveries, summed over the partners; the count of partners is what was published."""
    rows = partner_performance(m)
    total = F.sum("total_deliveries")
    return rows.agg(
        percent(F.sum("sla_breaches"), total, 2).alias("sla_breach_pct"),
        percent(F.count("sla_breaches"), total, 2).alias("published_pct"))


def demand_colors(m: Marketplace, as_of: date | None = None) -> DataFrame:
    value = F.col("demand_index")
    color = F.when(value >= DEMAND_COLORS[0][0], DEMAND_COLORS[0][1]).when(
        value >= DEMAND_COLORS[1][0], DEMAND_COLORS[1][1]).otherwise(DEMAND_COLORS[2][1])
    return hourly_demand(m).select("day_of_week", "hour_of_day", "demand_index", color.alias("color"))


def tier_colors(m: Marketplace, as_of: date | None = None) -> DataFrame:
    tier = F.col("customer_tier")
    color = F.lit(OTHER_TIER)
    for name, code in reversed(TIER_COLORS.items()):
        color = F.when(tier == name, code).otherwise(color)
    return m.customers("customer_tier").groupBy("customer_tier").agg(F.count(F.lit(1)).alias("customers")).withColumn(
        "color", color)


def best_and_worst_partners(m: Marketplace, as_of: date | None = None, k: int = 20) -> DataFrame:
    """The ``k`` best and ``k`` worst partners by on-time share."""
    rows = partner_performance(m).filter("on_time_rate_pct is not null").select(
        "partner_id", "partner_name", "vehicle_type", "city_name", "on_time_rate_pct")
    best = top(rows, k, desc("on_time_rate_pct"), asc("partner_id")).withColumn("side", F.lit("top"))
    worst = top(rows, k, asc("on_time_rate_pct"), asc("partner_id")).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def trips_per_day_histogram(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Partner days by number of deliveries."""
    return partner_days(m).groupBy(F.col("trips").alias("deliveries_that_day")).agg(
        F.count(F.lit(1)).alias("partner_days"))


def earnings_by_vehicle(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Quartiles of earnings per delivery by vehicle."""
    kinds = m.delivery_partners("partner_id", "vehicle_type")
    trips = done_trips(m, "partner_id", "partner_earnings").join(kinds, "partner_id")
    trips = trips.withColumn("_c", (F.col("partner_earnings") * 100).cast("long"))
    ends = trips.groupBy("vehicle_type").agg(F.min("partner_earnings").alias("lowest"),
                                             F.max("partner_earnings").alias("highest"))
    points = percentiles(trips, ["vehicle_type"], "_c", [25, 50, 75])
    return ends.join(points, "vehicle_type").select(
        "vehicle_type", "lowest", *[rounded(F.col(f"p{p}"), 2, scale=2).alias(f"q{i}") for i, p in
                                    enumerate((25, 50, 75), 1)], "highest")


def zone_alerts(m: Marketplace, as_of: date | None = None, late_pct: int = 15, target_percent: int = 130,
                min_partners: int = 5) -> DataFrame:
    """Flags per zone: too many late deliveries, too slow for the target, too few available partners."""
    n = F.count(F.lit(1))
    trips = done_trips(m, "order_id", "actual_time_mins", "sla_breached")
    per = trips.join(m.orders("order_id", "zone_id"), "order_id").groupBy("zone_id").agg(
        n.alias("_n"), count_where(F.col("sla_breached")).alias("_late"), F.sum("actual_time_mins").alias("_mins"))
    free = m.delivery_partners("zone_id", "is_active", "current_status").filter(
        F.col("is_active") & (F.col("current_status") == "Available")).groupBy("zone_id").agg(n.alias("_free"))
    rows = zone_names(m, "avg_delivery_time_mins").join(per, "zone_id", "left").join(free, "zone_id", "left")
    count, target = F.col("_n"), F.col("avg_delivery_time_mins")
    free = F.coalesce("_free", F.lit(0))
    return rows.select(
        "zone_name", "city_name", percent(F.col("_late"), count, 1).alias("sla_breach_pct"),
        ratio(F.col("_mins"), count, 1).alias("avg_mins"), target.alias("target_mins"),
        free.cast("long").alias("available_partners"),
        F.coalesce(F.col("_late") * 100 > count * late_pct, F.lit(False)).alias("late_alert"),
        F.coalesce(F.col("_mins") * 100 > count * target * target_percent, F.lit(False)).alias("slow_alert"),
        (free < min_partners).alias("partner_alert"))


def value_histogram(m: Marketplace, as_of: date | None = None, bins: int = 50) -> DataFrame:
    """Customers by lifetime value in equal-width bins."""
    spend = delivered(m, "customer_id", "total_amount").groupBy("customer_id").agg(
        F.sum("total_amount").cast("decimal(24,2)").alias("ltv"))
    return histogram(spend, "ltv", bins)


def order_value_by_channel(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Order value by acquisition channel; orders are summed per customer before the join."""
    per = delivered(m, "customer_id", "total_amount").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_sum"))
    rows = per.join(m.customers("customer_id", "acquisition_channel"), "customer_id")
    return rows.groupBy("acquisition_channel").agg(
        F.sum("_n").alias("orders"), ratio(F.sum("_sum"), F.sum("_n"), 2, num_scale=2).alias("aov"))


def rating_trend(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Average overall rating per restaurant and month."""
    return m.reviews("restaurant_id", "overall_rating", "created_at").groupBy(
        "restaurant_id", month_of(F.col("created_at")).alias("month")).agg(
        mean(F.col("overall_rating"), 2).alias("avg_rating"), F.count("overall_rating").alias("ratings"))


def rating_against_orders(m: Marketplace, as_of: date | None = None) -> DataFrame:
    return places(m, "restaurant_name", "rating", "total_orders").select(
        "restaurant_id", "restaurant_name", "rating", "total_orders")


def health_distribution(m: Marketplace, as_of: date, step: int = 10) -> DataFrame:
    """Restaurants by health score in steps, and their status."""
    rows = health_scores(m, as_of, corrected=True)
    low = (F.floor(F.col("health_score") / step) * step).cast("int")
    return rows.groupBy(low.alias("score_from"), "partner_status").agg(F.count(F.lit(1)).alias("restaurants"))


def segment_with_revenue(m: Marketplace, as_of: date) -> DataFrame:
    """Full segmentation with revenue attribution."""
    return rfm_summary(m, as_of)
