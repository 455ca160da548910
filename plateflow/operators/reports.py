"""Short reports over the summary views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from plateflow.functions.bands import band
from plateflow.functions.exact import count_where, mean, ratio, sum_where
from plateflow.functions.ordering import asc, desc, top
from plateflow.model import Marketplace
from plateflow.operators.views import customer_rfm, hourly_demand, partner_performance, restaurant_performance


def peak_cells(m: Marketplace, as_of: date | None = None, k: int = 50) -> DataFrame:
    rows = top(hourly_demand(m), k, desc("demand_index"), asc("day_of_week"), asc("hour_of_day"))
    return rows.select("day_of_week", "day_name", "hour_of_day", "order_count", "demand_index", "avg_order_value")


def top_restaurants(m: Marketplace, as_of: date | None = None, k: int = 20) -> DataFrame:
    rows = restaurant_performance(m).filter(F.col("revenue_rank") <= k)
    return rows.select("restaurant_name", "cuisine_type", "city_name", "total_orders", "gross_revenue",
                       "avg_order_value", "avg_food_rating", "revenue_rank").orderBy("revenue_rank", "restaurant_name")


def rfm_segments(m: Marketplace, as_of: date) -> DataFrame:
    return customer_rfm(m, as_of).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), mean(F.col("monetary"), 2, 2).alias("avg_ltv"),
        F.sum("monetary").alias("total_revenue")).orderBy(F.desc("avg_ltv"), "rfm_segment")


def delivery_profiles(m: Marketplace, as_of: date | None = None, k: int = 30) -> DataFrame:
    """Distinct combinations of zone and partner figures, busiest first."""
    names = ("zone_name", "city_name", "total_deliveries", "avg_delivery_time", "on_time_rate_pct", "sla_breaches")
    rows = partner_performance(m).select(*names).distinct()
    return top(rows, k, desc("total_deliveries"), *[asc(n) for n in names if n != "total_deliveries"])


def churn_segments(m: Marketplace, as_of: date,
                   segments: tuple[str, ...] = ("At Risk", "Hibernating", "Lost")) -> DataFrame:
    rows = customer_rfm(m, as_of).filter(F.col("rfm_segment").isin(*segments))
    return rows.groupBy(F.col("rfm_segment").alias("churn_segment")).agg(
        F.count(F.lit(1)).alias("customers"), mean(F.col("recency_days"), 0).alias("avg_days_inactive"),
        mean(F.col("monetary"), 2, 2).alias("avg_ltv")).orderBy(F.desc("avg_ltv"), "churn_segment")


def rfm_distribution(m: Marketplace, as_of: date) -> DataFrame:
    return customer_rfm(m, as_of).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), mean(F.col("monetary"), 0, 2).alias("avg_ltv"),
        ratio(F.sum("monetary"), F.lit(1), 0, num_scale=2).alias("total_revenue"),
        mean(F.col("recency_days"), 0).alias("avg_days_inactive"))


def recency_revenue(m: Marketplace, as_of: date, bounds: tuple[int, ...] = (14, 30, 60, 90)) -> DataFrame:
    names = ("Active (0-14d)", "Cooling (15-30d)", "At Risk (31-60d)", "Churning (61-90d)", "Churned (90d+)")
    rows = customer_rfm(m, as_of).groupBy(band(F.col("recency_days"), bounds, names).alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"),
        ratio(F.sum("monetary"), F.lit(1), 0, num_scale=2).alias("at_risk_revenue"), F.min("recency_days").alias("_at"))
    return rows.orderBy("_at").drop("_at")


def demand_heatmap(m: Marketplace, as_of: date | None = None) -> DataFrame:
    return hourly_demand(m).select("day_of_week", "day_name", "hour_of_day", "order_count", "demand_index")


def demand_pivot(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Weekdays as rows, the 24 hours as columns."""
    rows = hourly_demand(m).groupBy("day_of_week").pivot("hour_of_day", list(range(24))).agg(F.max("demand_index"))
    return rows.select("day_of_week", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def valuable_at_risk(m: Marketplace, as_of: date, days: int = 60, min_spend: int = 2000) -> DataFrame:
    risk = (F.col("recency_days") > days) & (F.col("monetary") > min_spend)
    return customer_rfm(m, as_of).agg(
        count_where(risk).alias("high_val_at_risk"),
        ratio(sum_where(risk, F.col("monetary")), F.lit(1), 0, num_scale=2).alias("revenue_at_risk"))
