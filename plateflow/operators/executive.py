"""Platform tiles, trends and unit economics."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from plateflow.functions.dates import days_before, first_of_month, month_of, shift_months
from plateflow.functions.exact import attach, count_where, growth, mean, percent, ratio, sum_where
from plateflow.functions.ordering import asc, desc, ordered, top
from plateflow.model import Marketplace
from plateflow.operators.common import activity_months, delivered, distinct, everything, is_cancelled, is_delivered, \
    trailing, truncated_growth, upto
from plateflow.operators.views import daily_kpi

CENTS = {"num_scale": 2, "den_scale": 2}


def month_tiles(m: Marketplace, as_of: date, corrected: bool = False) -> DataFrame:
    """Month to date against the whole previous month, in one scan of the two months.

    The published customer growth divides whole numbers and loses the fraction;
    ``corrected`` keeps it.
    """
    start = first_of_month(as_of)
    orders = m.orders("order_date", "order_status", "total_amount", "platform_commission", "discount_amount",
                      "customer_id", "restaurant_id", since=shift_months(start, -1))
    now, live = F.col("order_date") >= F.lit(start), ~is_cancelled()
    one = orders.agg(
        sum_where(now & live, F.col("total_amount")).alias("gmv"),
        sum_where(now & is_delivered(), F.col("platform_commission")).alias("rev"),
        count_where(now).alias("n"), count_where(now & is_delivered()).alias("done"),
        count_where(now & ~live).alias("lost"),
        F.count_distinct(F.when(now, F.col("customer_id"))).alias("people"),
        F.count_distinct(F.when(now, F.col("restaurant_id"))).alias("rests"),
        sum_where(now, F.col("discount_amount")).alias("disc"),
        sum_where(~now & live, F.col("total_amount")).alias("gmv0"),
        F.count_distinct(F.when(~now, F.col("customer_id"))).alias("people0"))
    c = F.col
    customers = growth(c("people"), c("people0"), 1) if corrected else truncated_growth(c("people"), c("people0"))
    return one.select(
        F.lit(as_of.strftime("%B %Y")).alias("period"), c("gmv").alias("mtd_gmv"), c("rev").alias("platform_revenue"),
        percent(c("rev"), c("gmv"), 2, **CENTS).alias("take_rate_pct"), c("n").alias("total_orders"),
        c("done").alias("delivered_orders"), c("lost").alias("cancelled_orders"),
        percent(c("lost"), c("n"), 2).alias("cancellation_rate_pct"), c("people").alias("active_customers"),
        c("rests").alias("active_restaurants"), ratio(c("gmv"), c("done"), 2, num_scale=2).alias("avg_order_value"),
        c("disc").alias("discounts_given"), percent(c("disc"), c("gmv"), 2, **CENTS).alias("discount_rate_pct"),
        growth(c("gmv"), c("gmv0"), 1, 2).alias("gmv_mom_growth_pct"), customers.alias("customer_mom_growth_pct"))


@ordered(desc("month"))
def gmv_trend(m: Marketplace, as_of: date, months: int = 24, lag: int = 12) -> DataFrame:
    """The first day of each month, with running total, three-row average and the row ``lag`` before."""
    days = daily_kpi(m, as_of, since=shift_months(as_of, -months)).filter(F.dayofmonth("day") == 1)
    w = everything().orderBy("day")
    last3 = trailing("day", 2)
    days = days.withColumns({
        "cumulative_gmv": F.sum("gross_revenue").over(upto("day")),
        "ma_3month_gmv": ratio(F.sum("gross_revenue").over(last3), F.count("gross_revenue").over(last3), 2, num_scale=2),
        "same_month_last_year": F.lag("gross_revenue", lag).over(w)})
    return days.select(
        F.col("day").alias("month"), F.col("gross_revenue").alias("gmv"), "platform_revenue", "avg_order_value",
        "total_orders", "active_customers", "cancellation_rate_pct", "cumulative_gmv", "ma_3month_gmv",
        "same_month_last_year",
        growth(F.col("gross_revenue"), F.col("same_month_last_year"), 1, 2).alias("yoy_growth_pct"))


def unit_economics(m: Marketplace, as_of: date, days: int = 30) -> DataFrame:
    """Contribution per order over the trailing window."""
    since = days_before(as_of, days)
    orders = m.orders("order_status", "total_amount", "platform_commission", "discount_amount", "customer_id",
                      "restaurant_id", since=since)
    one = orders.agg(
        sum_where(is_delivered(), F.col("total_amount")).alias("net_gmv"),
        sum_where(is_delivered(), F.col("platform_commission")).alias("platform_rev"),
        F.sum("discount_amount").alias("total_discounts"), count_where(is_delivered()).alias("_n"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("restaurant_id").alias("unique_restaurants"))
    start = F.lit(datetime(since.year, since.month, since.day)).cast("timestamp_ntz")
    paid = m.deliveries("delivered_at", "delivery_status", "partner_earnings", own_since=since).filter(
        (F.col("delivered_at") >= start) & (F.col("delivery_status") == "Delivered")).agg(
        F.sum("partner_earnings").alias("delivery_cost"))
    c = F.col
    margin = c("platform_rev") - c("delivery_cost") - c("total_discounts")

    def each(value):
        return ratio(value, c("_n"), 2, num_scale=2)

    return attach(one, paid).select(
        "net_gmv", "platform_rev", "delivery_cost", "total_discounts", margin.alias("contribution_margin"),
        each(c("net_gmv")).alias("avg_order_value"), each(c("platform_rev")).alias("revenue_per_order"),
        each(c("delivery_cost")).alias("delivery_cost_per_order"),
        each(c("total_discounts")).alias("discount_per_order"), each(margin).alias("cm_per_order"),
        percent(c("platform_rev"), c("net_gmv"), 2, **CENTS).alias("take_rate_pct"), "unique_customers",
        "unique_restaurants")


@ordered(desc("month"))
def new_and_returning(m: Marketplace, as_of: date | None = None, k: int = 24, corrected: bool = False) -> DataFrame:
    """Customers in their first month against returning ones; the latest ``k`` months."""
    fresh = F.col("month_number") == 0
    rows = activity_months(m).groupBy("month").agg(
        F.count(F.lit(1)).alias("total_active"), count_where(fresh).alias("new_customers"),
        count_where(~fresh).alias("returning_customers"))
    rows = rows.withColumn("prev_new_customers", F.lag("new_customers").over(everything().orderBy("month")))
    new, before = F.col("new_customers"), F.col("prev_new_customers")
    change = growth(new, before, 1) if corrected else truncated_growth(new, before)
    return top(rows, k, desc("month")).select(
        "month", "total_active", "new_customers", "returning_customers",
        percent(new, F.col("total_active"), 1).alias("new_pct"),
        percent(F.col("returning_customers"), F.col("total_active"), 1).alias("returning_pct"),
        "prev_new_customers", change.alias("new_customer_growth_pct"))


@ordered(desc("month"))
def monthly_growth(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Delivered value per month, growth and running total."""
    rows = delivered(m, "order_date", "total_amount").groupBy(month_of(F.col("order_date")).alias("month")).agg(
        F.sum("total_amount").alias("gmv"))
    rows = rows.withColumn("prev_gmv", F.lag("gmv").over(everything().orderBy("month")))
    return rows.withColumns({
        "mom_growth_pct": growth(F.col("gmv"), F.col("prev_gmv"), 1, 2),
        "cumulative_gmv": F.sum("gmv").over(upto("month"))})


@ordered(desc("order_date"))
def moving_orders(m: Marketplace, as_of: date | None = None, w: tuple[int, int] = (7, 30), k: int = 90) -> DataFrame:
    """Daily delivered orders with averages over the last rows (days without orders have no row)."""
    rows = delivered(m, "order_date").groupBy("order_date").agg(F.count(F.lit(1)).alias("daily_orders"))
    frames = {f"ma_{n}day": trailing("order_date", n - 1) for n in w}
    rows = rows.withColumns({
        name: ratio(F.sum("daily_orders").over(f), F.count(F.lit(1)).over(f), 1) for name, f in frames.items()})
    return top(rows, k, desc("order_date"))


def moving_orders_calendar(m: Marketplace, as_of: date | None = None, days: int = 7) -> DataFrame:
    """The same average over calendar days: missing days are added with zero orders."""
    rows = delivered(m, "order_date").groupBy("order_date").agg(F.count(F.lit(1)).alias("daily_orders"))
    span = rows.agg(F.explode(F.sequence(F.min("order_date"), F.max("order_date"), F.expr("interval 1 day")))
                    .alias("order_date"))
    full = span.join(rows, "order_date", "left").withColumn("daily_orders", F.coalesce("daily_orders", F.lit(0)))
    frame = trailing("order_date", days - 1)
    return full.withColumn("ma_days", ratio(F.sum("daily_orders").over(frame), F.count(F.lit(1)).over(frame), 1))


@ordered(desc("order_date"))
def platform_revenue_trend(m: Marketplace, as_of: date | None = None, w: int = 30, lag: int = 30,
                           k: int = 60) -> DataFrame:
    rows = delivered(m, "order_date", "platform_commission").groupBy("order_date").agg(
        F.sum("platform_commission").alias("platform_rev"))
    rows = rows.withColumns({
        "running_total": F.sum("platform_rev").over(upto("order_date")),
        "rolling_30d_rev": F.sum("platform_rev").over(trailing("order_date", w - 1)),
        "same_day_30d_ago": F.lag("platform_rev", lag).over(everything().orderBy("order_date"))})
    rows = rows.withColumn("growth_vs_30d_ago_pct", growth(F.col("platform_rev"), F.col("same_day_30d_ago"), 1, 2))
    return top(rows, k, desc("order_date"))


@ordered(desc("order_date"))
def daily_growth(m: Marketplace, as_of: date, days: int = 90, w: int = 7, corrected: bool = False) -> DataFrame:
    """Day-over-day growth of delivered orders; published with whole-number division."""
    rows = delivered(m, "order_date", since=days_before(as_of, days)).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"))
    rows = rows.withColumn("prev_day_orders", F.lag("orders").over(everything().orderBy("order_date")))
    now, before, frame = F.col("orders"), F.col("prev_day_orders"), trailing("order_date", w - 1)
    change = growth(now, before, 2) if corrected else truncated_growth(now, before).cast("decimal(20,2)")
    return rows.withColumns({
        "dod_growth_pct": change, "ma_7d": ratio(F.sum("orders").over(frame), F.count(F.lit(1)).over(frame), 1)})


@ordered(desc("order_date"))
def daily_retention(m: Marketplace, as_of: date | None = None, w: int = 30, k: int = 60) -> DataFrame:
    """Share of each day's customers whose first month lies before, and its average over ``w`` rows."""
    # One shuffle: the days of a customer as a set, no longer than the calendar.
    per = delivered(m, "customer_id", "order_date").groupBy("customer_id").agg(F.collect_set("order_date").alias("_days"))
    days = per.select(month_of(F.array_min("_days")).alias("_cohort"), F.explode("_days").alias("order_date"))
    back = F.col("_cohort") < month_of(F.col("order_date"))
    rows = days.groupBy("order_date").agg(
        count_where(back).alias("returning_customers"), F.count(F.lit(1)).alias("total_active"))
    share = percent(F.col("returning_customers"), F.col("total_active"), 10)
    frame = trailing("order_date", w - 1)
    rows = rows.withColumn("_share", share)
    rows = rows.withColumns({
        "retention_rate_pct": percent(F.col("returning_customers"), F.col("total_active"), 1),
        "rolling_30d_retention_pct": ratio(F.sum("_share").over(frame), F.count("_share").over(frame), 1, num_scale=10)})
    return top(rows, k, desc("order_date")).drop("_share")


def platform_kpis(m: Marketplace, as_of: date, days: int = 30, approximate: bool = False) -> DataFrame:
    orders = m.orders("order_status", "total_amount", "customer_id", "restaurant_id", since=days_before(as_of, days))
    return orders.agg(
        count_where(is_delivered()).alias("delivered_orders"), count_where(is_cancelled()).alias("cancelled_orders"),
        sum_where(is_delivered(), F.col("total_amount")).alias("gmv"),
        mean(F.when(is_delivered(), F.col("total_amount")), 2, 2).alias("aov"),
        distinct("customer_id", approximate).alias("unique_customers"),
        distinct("restaurant_id", approximate).alias("unique_restaurants"))


def platform_overview(m: Marketplace, as_of: date | None = None) -> DataFrame:
    orders = m.orders("order_status", "total_amount", "customer_id", "restaurant_id")
    return orders.agg(
        count_where(is_delivered()).alias("delivered"), count_where(is_cancelled()).alias("cancelled"),
        F.count(F.lit(1)).alias("total_orders"),
        ratio(sum_where(is_delivered(), F.col("total_amount")), F.lit(1), 0, num_scale=2).alias("gmv"),
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("restaurant_id").alias("restaurants"))


def recent_trend(m: Marketplace, as_of: date, days: int = 90, w: int = 7) -> DataFrame:
    """Daily orders and revenue; the average stays NULL until ``w`` rows exist."""
    rows = delivered(m, "order_date", "total_amount", since=days_before(as_of, days)).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))
    frame = trailing("order_date", w - 1)
    full = F.count(F.lit(1)).over(frame) == w
    return rows.withColumn("ma7", F.when(full, ratio(F.sum("orders").over(frame), F.lit(w), 4)))


def month_start_growth(m: Marketplace, as_of: date | None = None, k: int = 18) -> DataFrame:
    """First-of-month days with take rate and change against the previous such day."""
    days = daily_kpi(m, as_of).filter(F.dayofmonth("day") == 1)
    days = top(days, k, desc("day"))
    before = F.lag("gross_revenue").over(everything().orderBy("day"))
    return days.withColumn("_before", before).select(
        "day", F.col("gross_revenue").alias("gmv"), "platform_revenue", "total_orders", "active_customers",
        "avg_order_value", percent(F.col("platform_revenue"), F.col("gross_revenue"), 1, **CENTS).alias("take_rate_pct"),
        growth(F.col("gross_revenue"), F.col("_before"), 1, 2).alias("mom_growth_pct"))
