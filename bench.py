"""Headline timings over the benchmark star: load, view refresh, base-table and stored-view queries.

Prints one JSON line. ``value`` is the sum of the base-table queries (median of three warm runs each).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date

from pyspark.sql import functions as F

from plateflow.operators import customers, delivery, executive, operations, questions, reports, restaurants, views
from plateflow.plans.refresh import attach_views, refresh
from plateflow.session import local_session
from plateflow.sources.star import AS_OF, star_market
from plateflow.sources.store import open_store, order_history, write_orders, write_store


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(df) -> None:
    """Compute every row and column and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8, memory="12g")
    work = tempfile.mkdtemp(prefix="plateflow-bench-")
    star = star_market(spark, directory)

    def load() -> None:
        star.source.pin(f"{work}/core")
        write_store(star, f"{work}/store")

    one_off = {"load_store": timed(load)}
    base = open_store(spark, f"{work}/store")
    one_off["refresh_views_cold"] = timed(lambda: refresh(base, AS_OF, f"{work}/views"))
    one_off["refresh_views"] = timed(lambda: refresh(base, AS_OF, f"{work}/views"))
    # One month of orders is written anew: the refresh that follows a day's load.
    month = base.orders(since=date(1997, 5, 1), until=date(1997, 6, 1))
    month.write.parquet(f"{work}/month")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    write_orders(spark.read.parquet(f"{work}/month"), f"{work}/store/orders")
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    base = open_store(spark, f"{work}/store")
    one_off["refresh_views_one_month"] = timed(lambda: refresh(base, AS_OF, f"{work}/views"))
    fast = attach_views(open_store(spark, f"{work}/store"), f"{work}/views")
    someone = 42
    history = ("order_id", "customer_id", "order_timestamp", "total_amount", "order_status")
    on_base = {
        "customer_order_history": lambda: order_history(spark, f"{work}/store", someone, *history),
        "monthly_rollup_i20": lambda: executive.monthly_growth(base),
        "delivery_times_de1": lambda: delivery.delivery_times(base),
        "rfm_v6": lambda: views.customer_rfm(base, AS_OF),
        "demand_heatmap_v4": lambda: views.hourly_demand(base),
        "daily_kpi_v2": lambda: views.daily_kpi(base),
        "partner_average_og1": lambda: delivery.partner_average(base),
        "single_month": lambda: base.orders("total_amount", since=date(2000, 3, 1), until=date(2000, 4, 1)).agg(
            F.sum("total_amount")),
        "city_monthly_revenue": lambda: operations.city_monthly_revenue(base),
        "cohort_retention_cu1": lambda: customers.cohort_retention(base),
        "churn_risk_cu4": lambda: customers.churn_risk(base, AS_OF),
        "health_scores_re3": lambda: restaurants.health_scores(base, AS_OF),
        "top_items_re4": lambda: restaurants.top_items(base),
        "platform_kpis_ru1": lambda: executive.platform_kpis(base, AS_OF),
        "above_average_i25": lambda: questions.above_own_average(base),
    }
    on_views = {
        "daily_kpi_stored": lambda: views.daily_kpi(fast),
        "demand_heatmap_stored": lambda: views.hourly_demand(fast),
        "rfm_segments_stored": lambda: reports.rfm_segments(fast, AS_OF),
        "monthly_trend_stored": lambda: executive.gmv_trend(fast, AS_OF),
        "delivery_times_stored": lambda: delivery.delivery_times(fast),
        "cohort_retention_stored": lambda: customers.cohort_retention(fast),
    }
    timings = {}
    for name, make in (on_base | on_views).items():
        run(make())
        timings[name] = statistics.median(timed(lambda: run(make())) for _ in range(3))
    total = sum(timings[name] for name in on_base)
    print(json.dumps({
        "metric": "base_table_queries_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in (one_off | timings).items()},
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"), "cpus": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
