"""Registered checks of loading, storing, refreshing and reporting over the benchmark star."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, functions as F

from plateflow.functions.dates import month_of
from plateflow.functions.ordering import Want, add_orders, desc
from plateflow.functions.text import search_index, search_names, write_name_index
from plateflow.model import TABLES, Marketplace
from plateflow.operators.common import delivered
from plateflow.sources.csv_tables import load_csv
from plateflow.sources.seeds import fill_zones, insert_missing, row_counts
from plateflow.sources.store import open_store, write_store
from plateflow.session import cut
from plateflow.streaming.maintain import passing_workspace

# Columns of the generated files, per table.
CSV_COLUMNS = {
    "restaurants": ("restaurant_id", "restaurant_name", "cuisine_type", "city_id", "zone_id", "owner_name", "phone",
                    "email", "address", "rating", "avg_delivery_time_mins", "min_order_amount", "commission_rate",
                    "is_active", "is_pure_veg", "joining_date"),
    "menu_items": ("item_id", "restaurant_id", "category_id", "item_name", "price", "is_available", "is_vegetarian",
                   "calories", "is_bestseller"),
    "customers": ("customer_id", "customer_name", "email", "phone", "city_id", "registration_date", "is_active",
                  "customer_tier", "acquisition_channel"),
    "delivery_partners": ("partner_id", "partner_name", "phone", "email", "city_id", "zone_id", "vehicle_type",
                          "is_active", "current_status", "rating", "joining_date", "bg_verification"),
    "orders": ("order_id", "customer_id", "restaurant_id", "zone_id", "order_timestamp", "order_status",
               "order_channel", "subtotal_amount", "discount_amount", "delivery_fee", "taxes", "total_amount",
               "platform_commission", "payment_method", "cancellation_reason"),
    "order_items": ("order_id", "item_id", "quantity", "unit_price"),
    "deliveries": ("order_id", "partner_id", "assigned_at", "delivered_at", "actual_time_mins", "expected_time_mins",
                   "distance_km", "delivery_fee", "delivery_status", "partner_earnings"),
    "payments": ("order_id", "amount", "payment_method", "payment_status", "transaction_id", "payment_timestamp"),
}


def write_csv_tables(m: Marketplace, path: str) -> None:
    """The marketplace in the layout the CSV loaders read."""
    for name, columns in CSV_COLUMNS.items():
        # Spark writes folders; the loaders' patterns match folder names as well as files.
        target = f"{path}/orders_all.csv" if name == "orders" else f"{path}/{name}.csv"
        m.table(name, *columns).write.option("header", True).option("nullValue", "").option("emptyValue", "").csv(target)


def csv_round_trip(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Write all tables as CSV, load them with their types, and summarise what arrived."""
    with passing_workspace(m.spark) as path:
        write_csv_tables(m, path)
        return cut(_loaded(load_csv(m.spark, path)))


def _loaded(loaded: Marketplace) -> DataFrame:
    figures = {
        "restaurants": F.sum("rating"), "menu_items": F.sum("price"), "customers": F.sum("city_id"),
        "delivery_partners": F.sum("rating"), "orders": F.sum("total_amount"), "order_items": F.sum("item_total"),
        "deliveries": F.sum("partner_earnings"), "payments": F.sum("amount"),
    }
    out = None
    for name, figure in figures.items():
        one = loaded.table(name).agg(F.count(F.lit(1)).alias("rows"), figure.cast("decimal(30,2)").alias("figure"))
        one = one.select(F.lit(name).alias("entity"), "rows", "figure")
        out = one if out is None else out.unionByName(one)
    return out


def order_store(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Orders written by month and read back."""
    with passing_workspace(m.spark) as path:
        write_store(m, path, ["orders"])
        stored = open_store(m.spark, path, ["orders"])
        return cut(stored.orders("order_date", "total_amount").groupBy(month_of(F.col("order_date")).alias("month")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("total_amount")))


def table_sizes(m: Marketplace, as_of: date | None = None) -> DataFrame:
    return row_counts(**{name: m.table(name, TABLES[name].key) for name in TABLES})


# A figure of each view that a wrong or missing row changes.
FIGURES = {"daily_kpi": "total_orders", "restaurant_performance": "total_orders", "hourly_demand": "order_count",
           "partner_performance": "total_deliveries", "customer_rfm": "recency_days"}


def refreshed_views(m: Marketplace, as_of: date, names: Iterable[str] | None = None) -> DataFrame:
    """Refresh views (all by default) and report what the stored copies hold: rows, and the sum of a figure."""
    from plateflow.plans.refresh import attach_views, refresh

    with passing_workspace(m.spark) as path:
        done = refresh(m, as_of, path, names)
        stored = attach_views(m.detached(), path).stored
        out = None
        for name in done:
            one = stored[name][1].agg(F.count(F.lit(1)).alias("rows"), F.sum(FIGURES[name]).cast("long").alias("figure"))
            one = one.select(F.lit(name).alias("view"), "rows", "figure")
            out = one if out is None else out.unionByName(one)
        return cut(out)


def after_load(m: Marketplace, as_of: date) -> DataFrame:
    """The short refresh that follows a load."""
    from plateflow.plans.refresh import AFTER_LOAD

    return refreshed_views(m, as_of, AFTER_LOAD)


def inserted_customers(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Customers inserted twice over those with even numbers, which keep what they had."""
    people = m.customers("customer_id", "customer_name")
    known = people.filter("customer_id % 2 = 0").withColumn("customer_name", F.upper("customer_name"))
    return insert_missing(known, people.unionByName(people), "customer_id").select(
        "customer_id", F.concat("customer_name", F.lit("!")).alias("customer_name"))


def filled_zones(m: Marketplace, as_of: date | None = None, per_city: int = 10) -> DataFrame:
    """Numbered zones of every city; orders per city say how much they will have to serve."""
    load = m.orders("zone_id").join(m.zones("zone_id", "city_id"), "zone_id").groupBy("city_id").agg(
        F.count(F.lit(1)).alias("orders_in_city"))
    filled = fill_zones(m.cities("city_id", "city_name"), per_city)
    return filled.join(load, "city_id", "left").select(
        "zone_id", "city_id", "zone_name", "avg_delivery_time_mins", "is_active",
        F.coalesce("orders_in_city", F.lit(0)).alias("orders_in_city"))


REPORT_FIGURES = {"platform_kpis": "gmv", "peak_hours": "order_count", "top_restaurants": "gross_revenue",
                  "rfm_segments": "total_revenue", "delivery_performance": "total_deliveries", "churn_segments": "customers"}


def report_run(m: Marketplace, as_of: date) -> DataFrame:
    """Run the standard report and summarise the files it wrote."""
    from plateflow.plans.runner import run_report

    with passing_workspace(m.spark) as path:
        report = run_report(m, as_of, path)
        out = None
        for name, result in report["results"].items():
            if "error" in result:
                raise RuntimeError(f"{name}: {result['error']}")
            written = m.spark.read.option("header", True).csv(f"{path}/{name}")
            # The figure comes from the file, and the count the report states must be the file's.
            figure = F.sum(F.col(REPORT_FIGURES[name]).cast("decimal(18,2)")).cast("decimal(20,2)").alias("figure")
            one = written.agg(F.count(F.lit(1)).alias("rows"), figure)
            one = one.select(F.lit(name).alias("query"), "rows", (F.col("rows") == result["rows"]).alias("as_stated"), "figure")
            out = one if out is None else out.unionByName(one)
        return cut(out)


def name_search(m: Marketplace, as_of: date | None = None, query: str = "blue rings") -> DataFrame:
    """Menu item names close to a misspelt one."""
    names = m.menu_items("item_name").distinct()
    return search_names(names, "item_name", query)


#: Misspelt names looked for together.
SEARCHES = ("blue rings", "gren froste", "smoke almnd linen", "x", "")


def indexed_search(m: Marketplace, as_of: date | None = None, searches: tuple[str, ...] = SEARCHES) -> DataFrame:
    """Menu item names close to any of several misspelt ones, by a stored index."""
    queries = m.spark.createDataFrame(list(enumerate(searches)), "query_id int, query string")
    with passing_workspace(m.spark) as path:
        write_name_index(m.menu_items("item_name"), "item_name", path)
        return cut(search_index(m.spark, path, queries))


def global_order(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """All rankings of customers by spend."""
    spend = delivered(m, "customer_id", "total_amount").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").cast("decimal(24,2)").alias("spent"))
    return add_orders(spend, ["customer_id"], Want(
        (desc("orders"),), row_number="position", rank="rank", dense_rank="dense_rank", rows="customers",
        tiles=("tile", 7), running=("running_spent", "spent")))
