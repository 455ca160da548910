"""Restaurants, cuisines and menus."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window as W, functions as F

from plateflow.functions.bands import band
from plateflow.functions.dates import days_before, first_of_month, month_of, shift_months, sunday_zero
from plateflow.functions.exact import attach, count_where, growth, half_up, mean, percent, ratio, sum_where
from plateflow.functions.ordering import Want, add_orders, asc, desc, ordered, rank_among, top
from plateflow.model import Marketplace
from plateflow.operators.common import catalog, delivered, everything, is_cancelled, places, upto
from plateflow.operators.views import percent_rank


@ordered(desc("month"), desc("revenue"))
def monthly_ranking(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Revenue per restaurant and month, growth over its previous active month, standing within the month."""
    rows = delivered(m, "restaurant_id", "order_date", "customer_id", "total_amount", "platform_commission").groupBy(
        "restaurant_id", month_of(F.col("order_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"),
        F.sum("platform_commission").alias("platform_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"))
    # One row per month and restaurant: this window is as long as the calendar.
    own = W.partitionBy("restaurant_id").orderBy("month")
    rows = rows.withColumn("prev_month_rev", F.lag("revenue").over(own)).withColumn(
        "mom_growth_pct", growth(F.col("revenue"), F.col("prev_month_rev"), 1, 2))
    rows = rows.join(places(m, "restaurant_name", "cuisine_type"), "restaurant_id")
    rows = add_orders(
        rows, ["restaurant_id"],
        Want((desc("revenue"),), partition=("month",), rank="month_rank", rows="_n"),
        Want((asc("revenue"),), partition=("month",), tiles=("revenue_quartile", 4), rank="_up"),
    )
    return rows.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "city_name", "month", "orders", "revenue",
        "platform_revenue", "unique_customers", "prev_month_rev", "mom_growth_pct", "month_rank",
        "revenue_quartile", percent_rank("_up", "_n").alias("revenue_percentile"))


def restaurant_sales(m: Marketplace) -> DataFrame:
    """Delivered orders and revenue per restaurant, the input of everything joined to dimensions afterwards."""
    return delivered(m, "restaurant_id", "total_amount").groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_rev"))


@ordered(desc("total_revenue"))
def cuisine_share(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Market share per cuisine. The average rating is weighted by orders."""
    rests = m.restaurants("restaurant_id", "cuisine_type", "rating")
    weight = F.col("_n").cast("decimal(18,0)")
    rows = restaurant_sales(m).join(rests, "restaurant_id").groupBy("cuisine_type").agg(
        F.count(F.lit(1)).alias("restaurants"), F.sum("_n").alias("total_orders"),
        F.sum("_rev").alias("total_revenue"),
        F.sum((F.col("rating") * weight).cast("decimal(30,2)")).alias("_stars"),
        sum_where(F.col("rating").isNotNull(), F.col("_n")).alias("_rated"))
    w = everything()
    rows = rows.withColumns({
        "_all": F.sum("total_revenue").over(w), "revenue_rank": F.rank().over(w.orderBy(F.desc("total_revenue")))})
    return rows.select(
        "cuisine_type", "restaurants", "total_orders", "total_revenue",
        ratio(F.col("total_revenue"), F.col("total_orders"), 2, num_scale=2).alias("avg_order_value"),
        ratio(F.col("_stars"), F.col("_rated"), 2, num_scale=2).alias("avg_restaurant_rating"),
        percent(F.col("total_revenue"), F.col("_all"), 2, num_scale=2, den_scale=2).alias("revenue_share_pct"),
        "revenue_rank")


# Partner status labels.
STATUSES = ("⭐ Star Partner", "✅ Good Partner", "⚠️  Needs Improvement", "📊 Average")


@ordered(desc("health_score", nulls_last=True), asc("restaurant_id"))
def health_scores(m: Marketplace, as_of: date, recent: int = 30, corrected: bool = False) -> DataFrame:
    """Five-part health score of active restaurants.

    The published figures join orders, all reviews of the restaurant, deliveries and
    tickets, so counts are multiplied. The multiplicities are computed per order and
    per restaurant instead of building the product. ``corrected`` counts every order
    and ticket once and keeps the food part within 20 points.
    """
    trips = m.deliveries("order_id", "actual_time_mins").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_d"), F.sum("actual_time_mins").alias("_mins"),
        F.count("actual_time_mins").alias("_timed"))
    tickets = m.support_tickets("order_id").filter("order_id is not null").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_t"))
    orders = m.orders("order_id", "restaurant_id", "order_status", "order_date")
    df = orders.join(trips, "order_id", "left").join(tickets, "order_id", "left")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    t = F.coalesce("_t", zero)
    d = F.greatest(F.coalesce("_d", zero), one)
    lines, per_trip, seen = (one, one, t) if corrected else (d * F.greatest(t, one), F.greatest(t, one), t * d)
    sums = df.groupBy("restaurant_id").agg(
        F.sum(lines).alias("_orders"), sum_where(is_cancelled(), lines).alias("_cancelled"),
        sum_where(F.col("order_date") >= F.lit(days_before(as_of, recent)), lines).alias("_recent"),
        F.sum(seen).alias("_tickets"),
        F.sum(F.col("_mins") * per_trip).alias("_mins"), F.sum(F.col("_timed") * per_trip).alias("_timed"))
    food = m.reviews("restaurant_id", "food_rating").groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("_reviews"), mean(F.col("food_rating"), 2).alias("avg_food_rating"))
    rests = m.restaurants("restaurant_id", "restaurant_name", "cuisine_type", "city_id", "rating", "is_active")
    rests = rests.filter("is_active").join(m.cities("city_id", "city_name"), "city_id")
    df = rests.join(sums, "restaurant_id", "left").join(food, "restaurant_id", "left")
    fan = one if corrected else F.greatest(F.coalesce("_reviews", zero), one)

    def count(name: str):
        return (F.coalesce(name, zero) * fan)

    df = df.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "city_name", count("_orders").alias("total_orders"),
        count("_recent").alias("orders_last_30d"), "avg_food_rating", F.col("rating").alias("platform_rating"),
        count("_cancelled").alias("_lost"), ratio(F.col("_mins"), F.col("_timed"), 1).alias("avg_prep_to_delivery"),
        count("_tickets").alias("support_tickets"))
    total, lost, rating = F.col("total_orders"), F.col("_lost"), F.col("avg_food_rating")
    fixed = (
        F.coalesce("avg_food_rating", F.lit(0)) * (4 if corrected else 20)
        + F.least(F.expr("20.0"), F.col("orders_last_30d").cast("decimal(20,0)") * F.expr("0.2"))
        + F.coalesce("platform_rating", F.lit(0)) * 4
        + F.greatest(F.expr("0.0"), F.lit(20) - F.coalesce("avg_prep_to_delivery", F.lit(40)))
    ).cast("decimal(12,2)")
    # 2 * max(0, 10 - 100 lost / total), kept as a fraction until the one rounding.
    kept = F.greatest(zero, total * 20 - lost * 200)
    over = F.greatest(total, one)
    score = ratio(fixed * over.cast("decimal(20,0)") + F.when(total > 0, kept).otherwise(0), over, 1, num_scale=2)
    status = (
        F.when((rating >= 4.5) & (lost * 100 < total * 3), STATUSES[0]).when(rating >= 4.0, STATUSES[1])
        .when(rating < 3.5, STATUSES[2]).otherwise(STATUSES[3])
    )
    return df.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "city_name", "total_orders", "orders_last_30d",
        "avg_food_rating", "platform_rating", percent(lost, total, 2).alias("cancellation_rate_pct"),
        "avg_prep_to_delivery", "support_tickets", score.alias("health_score"), status.alias("partner_status"))


def item_sales(m: Marketplace) -> DataFrame:
    """Delivered lines and revenue per menu item."""
    lines = m.order_items("order_id", "item_id", "order_item_id", "item_total")
    sold = delivered(m, "order_id")
    return lines.join(sold, "order_id").groupBy("item_id").agg(
        F.count("order_item_id").alias("times_ordered"), F.sum("item_total").alias("total_revenue"))


@ordered(desc("times_ordered"), asc("item_id"))
def top_items(m: Marketplace, as_of: date | None = None, k: int = 50) -> DataFrame:
    """The ``k`` most ordered items with three ranks.

    Items ahead by frequency are themselves among the ``k``; only the revenue rank looks
    at the others, and it does so without sorting them.
    """
    sales = item_sales(m)  # the top-k and the ranking share its exchange
    best = top(sales, k, desc("times_ordered"), asc("item_id"))
    best = rank_among(best, sales, "total_revenue", "revenue_rank", k)
    info = catalog(m, "price", "is_vegetarian", "is_bestseller")
    rows = best.join(info, "item_id")
    by = F.desc("times_ordered")
    rows = rows.withColumns({
        "order_freq_rank": F.rank().over(everything().orderBy(by)),
        "cuisine_rank": F.rank().over(W.partitionBy("cuisine_type").orderBy(by))})
    return rows.select(
        "item_id", "item_name", "restaurant_name", "cuisine_type", "price", "is_vegetarian", "is_bestseller",
        "times_ordered", "total_revenue", "order_freq_rank", "revenue_rank", "cuisine_rank",
        F.col("is_bestseller").alias("officially_bestseller"))


@ordered(asc("days_to_100_orders"), asc("restaurant_name"))
def onboarding_ramp(m: Marketplace, as_of: date | None = None, milestones: tuple[int, int] = (100, 500),
                    min_orders: int = 100) -> DataFrame:
    """Days from joining to the 100th and 500th delivered order.

    Counting orders per day first makes the window as long as the calendar, however many
    orders one restaurant has; the day of the n-th order is the first to reach n.
    """
    ok = F.col("order_status") == "Delivered"
    days = m.orders("restaurant_id", "order_date", "order_status").groupBy("restaurant_id", "order_date").agg(
        F.count(F.lit(1)).alias("_n"), count_where(ok).alias("_done"))
    days = days.withColumn("_upto", F.sum("_done").over(upto("order_date", W.partitionBy("restaurant_id"))))
    rows = days.groupBy("restaurant_id").agg(
        F.sum("_n").alias("total_orders"), F.min("order_date").alias("first_order_date"),
        *[F.min(F.when(F.col("_upto") >= n, F.col("order_date"))).alias(f"_day{i}") for i, n in enumerate(milestones)])
    rows = rows.filter(F.col("total_orders") >= min_orders).join(
        places(m, "restaurant_name", "cuisine_type", "joining_date"), "restaurant_id")
    first = F.datediff("_day0", "joining_date")
    names = ("Fast Ramp", "Normal Ramp", "Slow Ramp", "Struggling")
    return rows.select(
        "restaurant_name", "cuisine_type", "city_name", "joining_date", "total_orders", "first_order_date",
        F.col("_day0").alias("date_100th_order"), first.alias("days_to_100_orders"),
        F.datediff("_day1", "joining_date").alias("days_to_500_orders"),
        band(first, (30, 60, 90), names).alias("ramp_category"))


@ordered(desc("rating"), asc("restaurant_id"))
def rated_active(m: Marketplace, as_of: date | None = None, min_rating: float = 4.5) -> DataFrame:
    return m.restaurants("restaurant_id", "restaurant_name", "cuisine_type", "rating", "total_orders",
                         "is_active").filter("is_active").filter(F.col("rating") > min_rating).drop("is_active")


@ordered(desc("cancel_rate_pct"), asc("cuisine_type"))
def cancellation_by_cuisine(m: Marketplace, as_of: date | None = None) -> DataFrame:
    per = m.orders("restaurant_id", "order_status").groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("_n"), count_where(is_cancelled()).alias("_c"))
    rows = per.join(m.restaurants("restaurant_id", "cuisine_type"), "restaurant_id").groupBy("cuisine_type").agg(
        F.sum("_n").alias("total_orders"), F.sum("_c").alias("cancellations"))
    return rows.withColumn("cancel_rate_pct", percent(F.col("cancellations"), F.col("total_orders"), 2))


@ordered(desc("total_orders"), asc("restaurant_id"))
def recent_busy(m: Marketplace, as_of: date, months: int = 3, min_orders: int = 100) -> DataFrame:
    """Restaurants that joined in the last ``months`` and already have many orders."""
    df = places(m, "restaurant_name", "cuisine_type", "joining_date", "total_orders", "rating")
    return df.filter((F.col("joining_date") >= F.lit(shift_months(as_of, -months)))
                     & (F.col("total_orders") > min_orders)).select(
        "restaurant_id", "restaurant_name", "cuisine_type", "city_name", "joining_date", "total_orders", "rating")


@ordered(desc("avg_food_rating"), asc("cuisine_type"))
def ratings_by_cuisine(m: Marketplace, as_of: date | None = None, min_reviews: int = 50) -> DataFrame:
    per = m.reviews("restaurant_id", "food_rating", "delivery_rating").groupBy("restaurant_id").agg(
        *[f("food_rating").alias(f"_f{i}") for i, f in enumerate((F.sum, F.count))],
        *[f("delivery_rating").alias(f"_d{i}") for i, f in enumerate((F.sum, F.count))],
        F.count(F.lit(1)).alias("_n"))
    rows = per.join(m.restaurants("restaurant_id", "cuisine_type"), "restaurant_id").groupBy("cuisine_type").agg(
        ratio(F.sum("_f0"), F.sum("_f1"), 2).alias("avg_food_rating"),
        ratio(F.sum("_d0"), F.sum("_d1"), 2).alias("avg_delivery_rating"), F.sum("_n").alias("review_count"))
    return rows.filter(F.col("review_count") >= min_reviews)


@ordered(desc("total_orders"), asc("restaurant_id"))
def unreviewed(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Active restaurants without any review."""
    df = places(m, "restaurant_name", "cuisine_type", "joining_date", "total_orders", "is_active").filter("is_active")
    return df.join(m.reviews("restaurant_id").distinct(), "restaurant_id", "left_anti").select(
        "restaurant_id", "restaurant_name", "cuisine_type", "city_name", "joining_date", "total_orders")


@ordered(asc("city_name"), asc("city_rank"))
def city_ranking(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Restaurants by revenue within their city and overall."""
    rows = restaurant_sales(m).join(places(m, "restaurant_name"), "restaurant_id").withColumnRenamed("_rev", "revenue")
    rows = add_orders(
        rows, ["restaurant_id"],
        Want((desc("revenue"),), partition=("city_name",), rank="city_rank"),
        Want((desc("revenue"),), dense_rank="overall_dense_rank"))
    return rows.select("city_name", "restaurant_name", "revenue", "city_rank", "overall_dense_rank")


@ordered(asc("city_name"))
def nth_cuisine(m: Marketplace, as_of: date | None = None, place: int = 2) -> DataFrame:
    """The cuisine in the given place per city by orders; ties share the place."""
    rows = restaurant_sales(m).join(places(m, "cuisine_type"), "restaurant_id").groupBy(
        "city_name", "cuisine_type").agg(F.sum("_n").alias("second_place_orders"))
    rank = F.rank().over(W.partitionBy("city_name").orderBy(F.desc("second_place_orders")))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == place).drop("_rank")


@ordered(desc("peak_hour_orders"), asc("restaurant_name"))
def peak_hours(m: Marketplace, as_of: date | None = None, k: int = 20) -> DataFrame:
    """The busiest hour of each restaurant (the earlier one on a tie), busiest restaurants first."""
    hours = delivered(m, "restaurant_id", "order_timestamp").groupBy(
        "restaurant_id", F.hour("order_timestamp").alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    peak = hours.groupBy("restaurant_id").agg(
        F.max("_n").alias("peak_hour_orders"), F.max_by("_hour", F.struct(F.col("_n"), -F.col("_hour"))).alias("_hour"))
    rests = m.restaurants("restaurant_id", "restaurant_name", "cuisine_type")
    kept = top(peak, k, desc("peak_hour_orders"), asc("restaurant_id"))
    return kept.join(rests, "restaurant_id").select(
        "restaurant_name", "cuisine_type", F.concat(F.col("_hour").cast("string"), F.lit(":00")).alias("peak_hour"),
        "peak_hour_orders")


@ordered(desc("improvement"), asc("restaurant_name"))
def improved_ratings(m: Marketplace, as_of: date, months: int = 3) -> DataFrame:
    """Restaurants whose average food rating this month beats the one ``months`` ago."""
    now, then = first_of_month(as_of), shift_months(first_of_month(as_of), -months)
    month = month_of(F.col("created_at"))
    rows = m.reviews("restaurant_id", "food_rating", "created_at").filter(
        F.col("created_at") >= F.lit(datetime(then.year, then.month, 1)).cast("timestamp_ntz"))
    food = F.col("food_rating")
    rows = rows.groupBy("restaurant_id").agg(
        mean(F.when(month == F.lit(now), food), 2).alias("current_rating"),
        mean(F.when(month == F.lit(then), food), 2).alias("rating_3m_ago"))
    rows = rows.filter(F.col("current_rating") > F.col("rating_3m_ago"))
    return rows.join(places(m, "restaurant_name", "cuisine_type"), "restaurant_id").select(
        "restaurant_name", "cuisine_type", "city_name", "current_rating", "rating_3m_ago",
        half_up(F.col("current_rating") - F.col("rating_3m_ago"), 2).alias("improvement"))


@ordered(desc("longest_streak_days"), asc("restaurant_name"))
def longest_streaks(m: Marketplace, as_of: date | None = None, k: int = 10) -> DataFrame:
    """Longest run of consecutive days with delivered orders, per restaurant name."""
    days = delivered(m, "restaurant_id", "order_date").select("restaurant_id", "order_date").distinct()
    own = W.partitionBy("restaurant_id").orderBy("order_date")
    runs = days.withColumn("_run", F.date_sub("order_date", F.row_number().over(own))).groupBy(
        "restaurant_id", "_run").agg(F.count(F.lit(1)).alias("_days"))
    best = runs.groupBy("restaurant_id").agg(F.max("_days").alias("_days"))
    rows = best.join(m.restaurants("restaurant_id", "restaurant_name"), "restaurant_id").groupBy(
        "restaurant_name").agg(F.max("_days").alias("longest_streak_days"))
    return top(rows, k, desc("longest_streak_days"), asc("restaurant_name"))


@ordered(lambda: (F.col("weekend_aov") - F.col("weekday_aov")).desc_nulls_last(), asc("restaurant_name"))
def weekday_weekend(m: Marketplace, as_of: date | None = None, min_orders: int = 100, k: int = 20) -> DataFrame:
    """Average order value on weekdays and weekends, per restaurant name."""
    weekend = sunday_zero(F.col("order_date")).isin(0, 6)
    per = delivered(m, "restaurant_id", "order_date", "total_amount").groupBy("restaurant_id").agg(
        count_where(weekend).alias("_we"), sum_where(weekend, F.col("total_amount")).alias("_we_sum"),
        count_where(~weekend).alias("_wd"), sum_where(~weekend, F.col("total_amount")).alias("_wd_sum"))
    rows = per.join(m.restaurants("restaurant_id", "restaurant_name"), "restaurant_id").groupBy("restaurant_name").agg(
        ratio(F.sum("_wd_sum"), F.sum("_wd"), 2, num_scale=2).alias("weekday_aov"),
        ratio(F.sum("_we_sum"), F.sum("_we"), 2, num_scale=2).alias("weekend_aov"),
        F.sum("_wd").alias("weekday_orders"), F.sum("_we").alias("weekend_orders"))
    rows = rows.filter(F.col("weekday_orders") + F.col("weekend_orders") > min_orders).withColumn(
        "_gap", F.col("weekend_aov") - F.col("weekday_aov"))
    return top(rows, k, desc("_gap", nulls_last=True), asc("restaurant_name")).drop("_gap")


@ordered(lambda: (F.col("current_revenue") / F.nullif(F.col("prev_3m"), F.lit(0))).asc_nulls_last(), asc("restaurant_name"))
def declining(m: Marketplace, as_of: date) -> DataFrame:
    """Restaurants whose revenue fell in each of the last three active months up to this one."""
    rows = delivered(m, "restaurant_id", "order_date", "total_amount").groupBy(
        "restaurant_id", month_of(F.col("order_date")).alias("month")).agg(
        F.sum("total_amount").alias("current_revenue"))
    own = W.partitionBy("restaurant_id").orderBy("month")
    rows = rows.withColumns({f"prev_{i}m": F.lag("current_revenue", i).over(own) for i in (1, 2, 3)})
    rows = rows.filter(
        (F.col("month") == F.lit(first_of_month(as_of))) & (F.col("current_revenue") < F.col("prev_1m"))
        & (F.col("prev_1m") < F.col("prev_2m")) & (F.col("prev_2m") < F.col("prev_3m")))
    return rows.join(places(m, "restaurant_name", "cuisine_type"), "restaurant_id").select(
        "restaurant_name", "cuisine_type", "city_name", "month", "current_revenue", "prev_1m", "prev_2m", "prev_3m")


@ordered(desc("total_quantity_ordered"), asc("item_name"))
def popular_items(m: Marketplace, as_of: date | None = None, k: int = 10) -> DataFrame:
    """Items by quantity over orders of every status; items of one name in one restaurant count together."""
    names = ("item_name", "restaurant_name", "cuisine_type")
    # The facts carry the number of a name, not the name; one row an order and name needs no distinct count.
    lines = m.order_items("order_id", "item_id", "quantity").join(_numbered(catalog(m), *names), "item_id")
    sold = lines.groupBy("order_id", "_name").agg(F.sum("quantity").alias("_q")).groupBy("_name").agg(
        F.sum("_q").alias("total_quantity_ordered"), F.count(F.lit(1)).alias("orders_containing_item"))
    rows = sold.join(_named(catalog(m), *names), "_name").select(*names, "total_quantity_ordered", "orders_containing_item")
    return top(rows, k, desc("total_quantity_ordered"), asc("item_name"), asc("restaurant_name"))


def _named(items: DataFrame, *names: str) -> DataFrame:
    """Each combination of names with a number, the smallest item that has it."""
    return items.groupBy(*names).agg(F.min("item_id").alias("_name"))


def _numbered(items: DataFrame, *names: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Items with the number of their names; joined among dimensions, before any fact."""
    return items.join(_named(items, *names), list(names)).select("item_id", "_name", *also)


CLASSES = ("A - Core (top 80%)", "B - Important (80-95%)", "C - Long Tail")


@ordered(desc("revenue"), asc("item_name"))
def abc_classes(m: Marketplace, as_of: date | None = None, cuts: tuple[int, int] = (80, 95),
                k: int | None = 50) -> DataFrame:
    """Items by cumulative share of revenue.

    With ``k`` the running sum needs the ``k`` largest items and the total only; without
    it every item is classified over a distributed running sum.
    """
    revenue = item_sales(m).select("item_id", F.col("total_revenue").cast("decimal(28,2)").alias("revenue"))
    if k is None:
        rows = add_orders(revenue, ["item_id"], Want((desc("revenue"),), running=("_upto", "revenue")))
    else:
        rows = top(revenue, k, desc("revenue"), asc("item_id"))
        ordered = everything().orderBy(F.desc("revenue"), "item_id").rowsBetween(W.unboundedPreceding, 0)
        rows = rows.withColumn("_upto", F.sum("revenue").over(ordered))
    rows = attach(rows, revenue.agg(F.sum("revenue").alias("_all")))
    share = percent(F.col("_upto"), F.col("_all"), 2, num_scale=2, den_scale=2)
    rows = rows.withColumn("cumulative_pct", share).join(catalog(m), "item_id")
    return rows.select("item_name", "restaurant_name", "revenue", "cumulative_pct",
                       band(F.col("cumulative_pct"), cuts, CLASSES).alias("abc_class"))


@ordered(desc("co_order_count"), asc("item_name"))
def ordered_together(m: Marketplace, as_of: date | None = None, cuisine: str = "Pizza", k: int = 15) -> DataFrame:
    """Items of other cuisines in orders that contain the given cuisine.

    Orders are matched by a semi join; pairs of items are never formed.
    """
    names = ("item_name", "cuisine_type")
    items = _numbered(catalog(m), *names, also=("cuisine_type",)).select(
        "item_id", "_name", (F.col("cuisine_type") == cuisine).alias("_mine"))
    # An order's names of either kind once; names are numbers until the few results are known.
    lines = m.order_items("order_id", "item_id").join(items, "item_id").groupBy("order_id", "_name", "_mine").agg(
        F.lit(1).alias("_one"))
    mine = lines.filter("_mine").select("order_id")
    others = lines.filter("not _mine").join(mine, "order_id", "left_semi")
    counted = others.groupBy("_name").agg(F.count(F.lit(1)).alias("co_order_count"))
    rows = counted.join(_named(catalog(m), *names), "_name").select(*names, "co_order_count")
    return top(rows, k, desc("co_order_count"), asc("item_name"), asc("cuisine_type"))


def top_cuisines(m: Marketplace, as_of: date | None = None, k: int = 12) -> DataFrame:
    rows = restaurant_sales(m).join(m.restaurants("restaurant_id", "cuisine_type"), "restaurant_id").groupBy(
        "cuisine_type").agg(F.sum("_n").alias("orders"), F.sum("_rev").alias("_rev"))
    rows = rows.select("cuisine_type", "orders", ratio(F.col("_rev"), F.lit(1), 0, num_scale=2).alias("revenue"),
                       ratio(F.col("_rev"), F.col("orders"), 2, num_scale=2).alias("aov"))
    return top(rows, k, desc("revenue"), asc("cuisine_type"))
