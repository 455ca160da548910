"""Retention, segmentation, lifetime value, churn and acquisition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from plateflow.functions.bands import band
from plateflow.functions.dates import days_before, month_label
from plateflow.functions.exact import count_where, half_up, mean, percent, ratio
from plateflow.functions.ordering import Want, add_orders, asc, desc, ordered
from plateflow.functions.tiles import Tiles, add_tiles
from plateflow.model import Marketplace
from plateflow.operators.common import cohort_counts, delivered, everything, is_cancelled
from plateflow.operators.views import customer_rfm, percent_rank


@ordered(asc("cohort"), asc("month_number"))
def cohort_retention(m: Marketplace, as_of: date | None = None, max_month: int = 12) -> DataFrame:
    """Share of each monthly cohort that ordered again, by months since the first order."""
    rows = cohort_counts(m, max_month)
    active, size = F.col("active_customers"), F.col("cohort_size")
    return rows.select(
        month_label(F.col("cohort")).alias("cohort"), "cohort_size", F.col("month_number"), "active_customers",
        percent(active, size, 1).alias("retention_pct"),
        percent(size - active, size, 1).alias("cumulative_churn_pct"))


@ordered(asc("cohort"))
def cohort_matrix(m: Marketplace, as_of: date | None = None, months: tuple[int, ...] = (0, 1, 3, 6)) -> DataFrame:
    """Cohorts as rows, retention in the chosen months as columns."""
    rows = cohort_counts(m, max(months)).filter(F.col("month_number").isin(*months))
    wide = rows.groupBy("cohort").agg(
        F.max("cohort_size").alias("cohort_size"),
        *[F.coalesce(F.max(F.when(F.col("month_number") == n, F.col("active_customers"))), F.lit(0)).alias(f"_{n}")
          for n in months])
    return wide.select(month_label(F.col("cohort")).alias("cohort"), "cohort_size",
                       *[percent(F.col(f"_{n}"), F.col("cohort_size"), 1).alias(f"m{n}") for n in months])


def retention_pivot(m: Marketplace, as_of: date | None = None, max_month: int = 6) -> DataFrame:
    """Retention matrix with one column per month; NULL where a cohort was not active."""
    rows = cohort_retention(m, as_of, max_month)
    out = rows.groupBy("cohort").pivot("month_number", list(range(max_month + 1))).agg(F.max("retention_pct"))
    return out.select("cohort", *[F.col(str(n)).alias(f"m{n}") for n in range(max_month + 1)])


def retention_rows(m: Marketplace, as_of: date | None = None, max_month: int = 6) -> DataFrame:
    return cohort_retention(m, as_of, max_month).select(
        "cohort", F.col("cohort_size").alias("sz"), F.col("month_number").alias("month_num"), "retention_pct")


def mean_first_month_retention(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Average of the month-1 column of the retention matrix."""
    rows = cohort_retention(m, as_of, 1).filter("month_number = 1")
    return rows.agg(mean(F.col("retention_pct"), 1, 1).alias("avg_month_1_retention_pct"))


def retention_report(m: Marketplace, as_of: date | None = None, year: int = 1996, month: int = 1) -> DataFrame:
    """One cohort: how many came back exactly 1, 3 and 6 months later."""
    chosen = date(year, month, 1)
    rows = cohort_counts(m, 6, cohort=chosen)
    wide = rows.groupBy("cohort").agg(
        F.max("cohort_size").alias("cohort_size"),
        *[F.coalesce(F.max(F.when(F.col("month_number") == n, F.col("active_customers"))), F.lit(0))
          .alias(f"retained_m{n}") for n in (1, 3, 6)])
    return wide.select(
        month_label(F.col("cohort")).alias("cohort_month"), "cohort_size", "retained_m1", "retained_m3",
        "retained_m6", *[percent(F.col(f"retained_m{n}"), F.col("cohort_size"), 1).alias(f"retention_m{n}_pct")
                         for n in (1, 3, 6)])


def cohort_activity_all(m: Marketplace, as_of: date | None = None, max_month: int = 6) -> DataFrame:
    """Cohort activity over orders of every status."""
    return cohort_counts(m, max_month, only_delivered=False).select(
        month_label(F.col("cohort")).alias("cohort"), "month_number", "active_customers")


@ordered(desc("avg_lifetime_spend"))
def rfm_summary(m: Marketplace, as_of: date) -> DataFrame:
    """Segments with their share of customers and revenue."""
    seg = customer_rfm(m, as_of).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean(F.col("monetary"), 2, 2).alias("avg_lifetime_spend"),
        F.sum("monetary").alias("total_revenue"),
        mean(F.col("recency_days"), 0).alias("avg_days_since_order"),
        mean(F.col("frequency"), 1).alias("avg_orders"),
        *[mean(F.col(f"{x}_score"), 2).alias(f"avg_{x}_score") for x in "rfm"],
    )
    w = everything()
    seg = seg.withColumns({"_n": F.sum("customer_count").over(w), "_rev": F.sum("total_revenue").over(w)})
    return seg.select(
        "rfm_segment", "customer_count", percent(F.col("customer_count"), F.col("_n"), 2).alias("pct_of_customers"),
        "avg_lifetime_spend", "total_revenue",
        percent(F.col("total_revenue"), F.col("_rev"), 2, num_scale=2, den_scale=2).alias("pct_of_revenue"),
        "avg_days_since_order", "avg_orders", "avg_r_score", "avg_f_score", "avg_m_score")


def customer_value(m: Marketplace, as_of: date) -> DataFrame:
    """Per customer: orders, spend, average, first and last day, age and orders per 30 days."""
    base = delivered(m, "customer_id", "order_date", "total_amount").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("historical_ltv"),
        mean(F.col("total_amount"), 2, 2).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    age = F.datediff(F.lit(as_of), F.col("first_order_date"))
    return base.withColumn("customer_age_days", age).withColumn(
        "orders_per_month", ratio(F.col("total_orders") * 30, F.col("customer_age_days"), 2))


@ordered(desc("historical_ltv"), asc("customer_id"))
def lifetime_value(m: Marketplace, as_of: date, horizon: int = 12) -> DataFrame:
    """Historical and projected value with rank, decile and percentile over all customers."""
    people = m.customers("customer_id", "customer_name", "customer_tier", "acquisition_channel", "city_id").join(
        m.cities("city_id", "city_name"), "city_id").drop("city_id")
    df = add_orders(
        customer_value(m, as_of).join(people, "customer_id"), ["customer_id"],
        Want((desc("historical_ltv"),), rank="ltv_rank", rows="_n"),
        Want((asc("historical_ltv"),), tiles=("ltv_decile", 10), rank="_up"),
    )
    return df.select(
        "customer_id", "customer_name", "customer_tier", "city_name", "acquisition_channel", "total_orders",
        "historical_ltv", "avg_order_value", "first_order_date", "last_order_date", "customer_age_days",
        "orders_per_month",
        half_up(F.col("orders_per_month") * horizon * F.col("avg_order_value"), 2).alias("projected_12m_ltv"),
        "ltv_rank", "ltv_decile", percent_rank("_up", "_n").alias("ltv_percentile"))


# The recommended actions.
ACTIONS = ("🚨 Win-Back VIP — send ₹100 voucher", "⚠️  Retention offer needed",
           "📧 Re-engagement push notification", "— Standard flow")


@ordered(desc("days_since_last_order"), asc("customer_id"))
def churn_risk(m: Marketplace, as_of: date, recent: int = 30, prev: int = 60, ticket_days: int = 90,
               corrected: bool = False) -> DataFrame:
    """Recency, trend and advice per active customer.

    The published figures join orders to recent tickets, so a customer with T tickets
    and N orders counts T x N rows. That product is computed from the two counts, not
    by the join. ``corrected`` counts orders and tickets once.
    """
    last30, day = days_before(as_of, recent), F.col("order_date")
    orders = m.orders("customer_id", "order_date", "order_status", "total_amount").groupBy("customer_id").agg(
        F.max("order_date").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("total_amount").alias("_spent"),
        count_where(day >= F.lit(last30)).alias("_recent"),
        count_where((day >= F.lit(days_before(as_of, prev))) & (day < F.lit(last30))).alias("_before"),
        count_where(is_cancelled()).alias("_cancelled"),
    )
    since = F.lit(days_before(as_of, ticket_days)).cast("timestamp_ntz")
    tickets = m.support_tickets("customer_id", "created_at").filter(F.col("created_at") >= since).groupBy(
        "customer_id").agg(F.count(F.lit(1)).alias("_tickets"))
    people = m.customers("customer_id", "customer_name", "customer_tier", "city_id", "is_active").filter(
        "is_active").join(m.cities("city_id", "city_name"), "city_id")
    df = people.join(orders, "customer_id", "left").join(tickets, "customer_id", "left")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    n, t = F.coalesce("_n", zero), F.coalesce("_tickets", zero)
    times, ticket_times = (one, one) if corrected else (F.greatest(t, one), F.greatest(n, one))
    df = df.select(
        "customer_id", "customer_name", "customer_tier", "city_name",
        F.datediff(F.lit(as_of), F.col("_last")).alias("days_since_last_order"),
        n.alias("total_orders"),
        (F.col("_spent") * times).cast("decimal(30,2)").alias("total_spent"),
        (F.coalesce("_recent", zero) * times).alias("orders_last_30d"),
        (F.coalesce("_before", zero) * times).alias("orders_prev_30d"),
        (t * ticket_times).alias("support_tickets"),
        percent(F.coalesce("_cancelled", zero) * times, n, 1).alias("cancellation_rate_pct"),
    )
    now, was, idle = F.col("orders_last_30d"), F.col("orders_prev_30d"), F.col("days_since_last_order")
    trend = (
        F.when(now * 2 < was, "Declining Fast").when(now < was, "Declining")
        .when((now == 0) & (was > 0), "Stopped").otherwise("Stable/Growing")
    )
    advice = (
        F.when((idle > 60) & (F.col("total_spent") > 5000), ACTIONS[0])
        .when((idle > 45) & (F.col("total_spent") > 2000), ACTIONS[1])
        .when((now == 0) & (F.col("total_orders") > 10), ACTIONS[2]).otherwise(ACTIONS[3])
    )
    names = ("Active", "Cooling", "At Risk", "Churning", "Churned")
    return df.withColumns({
        "order_trend": trend, "churn_segment": band(idle, (14, 30, 60, 90), names), "recommended_action": advice})


@ordered(desc("avg_ltv"))
def acquisition_channels(m: Marketplace, as_of: date | None = None, corrected: bool = False) -> DataFrame:
    """Activation, orders and value per channel.

    The published average lifetime value is weighted by orders; ``corrected`` averages
    over customers.
    """
    spend = delivered(m, "customer_id", "total_amount").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_ltv"))
    df = m.customers("customer_id", "acquisition_channel").join(spend, "customer_id", "left")
    ltv = F.col("_ltv").cast("decimal(26,2)")
    weight = F.lit(1).cast("long") if corrected else F.col("_n")
    rows = df.groupBy("acquisition_channel").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count("_n").alias("ordering_customers"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_orders"),
        F.sum("_ltv").alias("total_revenue"),
        F.sum((ltv * weight.cast("decimal(10,0)")).cast("decimal(36,2)")).alias("_weighted"),
        F.sum(F.when(F.col("_n").isNotNull(), weight)).alias("_weights"),
    )
    return rows.select(
        "acquisition_channel", "total_customers", "ordering_customers",
        percent(F.col("ordering_customers"), F.col("total_customers"), 1).alias("activation_rate_pct"),
        "total_orders",
        ratio(F.col("total_orders"), F.col("ordering_customers"), 1).alias("avg_orders_per_active"),
        "total_revenue",
        ratio(F.col("_weighted"), F.col("_weights"), 2, num_scale=2).alias("avg_ltv"),
        ratio(F.col("total_revenue"), F.col("total_customers"), 2, num_scale=2)
        .alias("revenue_per_acquired_customer"))


def recency_bands(m: Marketplace, as_of: date, bounds: tuple[int, ...] = (7, 14, 30, 60, 90, 180)) -> DataFrame:
    """Customers by days since their last delivered order."""
    last = delivered(m, "customer_id", "order_date").groupBy("customer_id").agg(F.max("order_date").alias("_last"))
    idle = F.datediff(F.lit(as_of), F.col("_last"))
    lows = (0, *[b + 1 for b in bounds[:-1]])
    names = [f"{lo}-{hi} days" for lo, hi in zip(lows, bounds)] + [f"{bounds[-1]}+ days (Churned)"]
    rows = last.groupBy(band(idle, bounds, names).alias("recency_band")).agg(
        F.count(F.lit(1)).alias("customers"), F.min(idle).alias("_from"))
    rows = rows.withColumn("_all", F.sum("customers").over(everything())).orderBy("_from")
    return rows.select("recency_band", "customers",
                       percent(F.col("customers"), F.col("_all"), 2).alias("pct_of_customers"))


@ordered(asc("quintile"))
def spending_quintiles(m: Marketplace, as_of: date | None = None, n: int = 5) -> DataFrame:
    """Customers in ``n`` equal groups by spend."""
    spend = delivered(m, "customer_id", "total_amount").groupBy("customer_id").agg(
        F.sum("total_amount").alias("_spent"))
    tiles = add_tiles(spend, "customer_id", Tiles(asc("_spent"), "quintile", n))
    return tiles.groupBy("quintile").agg(
        F.count(F.lit(1)).alias("customers"), F.min("_spent").alias("min_spend"), F.max("_spent").alias("max_spend"),
        mean(F.col("_spent"), 2, 2).alias("avg_spend"), F.sum("_spent").alias("total_revenue"))


@ordered(asc("ltv_quintile"))
def value_quintiles(m: Marketplace, as_of: date, n: int = 5, horizon: int = 12) -> DataFrame:
    """Customers in ``n`` equal groups by value, best first, with a projection per group."""
    tiles = add_tiles(customer_value(m, as_of), "customer_id", Tiles(desc("historical_ltv"), "ltv_quintile", n))
    pace, aov = F.col("orders_per_month"), F.col("avg_order_value")
    wide = "decimal(38,2)"
    rows = tiles.groupBy("ltv_quintile").agg(
        F.count(F.lit(1)).alias("customers"),
        mean(F.col("historical_ltv"), 2, 2).alias("avg_ltv"),
        F.sum("historical_ltv").alias("total_revenue"),
        mean(F.col("total_orders"), 1).alias("avg_orders"),
        mean(aov.cast("decimal(24,2)"), 2, 2).alias("avg_aov"),
        mean(pace.cast("decimal(24,2)"), 2, 2).alias("avg_orders_per_month"),
        F.sum(pace.cast(wide)).alias("_pace"), F.count(pace).alias("_paced"),
        F.sum(aov.cast(wide)).alias("_aov"),
    )
    cents = F.lit(100).cast("decimal(38,0)")
    product = (F.col("_pace") * cents).cast("decimal(38,0)") * (F.col("_aov") * cents).cast("decimal(38,0)")
    return rows.select(
        "ltv_quintile", "customers", "avg_ltv", "total_revenue", "avg_orders", "avg_aov", "avg_orders_per_month",
        ratio(product * F.lit(horizon).cast("decimal(38,0)"),
              F.col("_paced") * F.col("customers") * 10000, 2).alias("projected_12m_ltv"))
