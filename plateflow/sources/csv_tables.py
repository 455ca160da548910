"""Typed CSV input of the marketplace tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plateflow.model import TABLES, Marketplace, derive, from_frames

# File pattern per table; orders arrive as one file per month.
FILES = {
    "restaurants": "restaurants.csv", "menu_items": "menu_items.csv", "customers": "customers.csv",
    "delivery_partners": "delivery_partners.csv", "orders": "orders_*.csv", "order_items": "order_items.csv",
    "deliveries": "deliveries.csv", "payments": "payments.csv", "reviews": "reviews.csv",
    "support_tickets": "support_tickets.csv", "cities": "cities.csv", "zones": "zones.csv",
    "promotions": "promotions.csv", "menu_categories": "menu_categories.csv",
    "customer_addresses": "customer_addresses.csv", "order_status_history": "order_status_history.csv",
}
# Values a column takes when the file does not carry it.
DEFAULTS = {
    "cities": {"country": "India", "timezone": "Asia/Kolkata", "is_active": True},
    "zones": {"avg_delivery_time_mins": 25, "is_active": True},
    "restaurants": {"total_ratings": 0, "is_active": True, "is_pure_veg": False, "total_orders": 0,
                    "total_revenue": 0},
    "menu_items": {"is_available": True, "is_vegetarian": False, "preparation_time_mins": 15,
                   "is_bestseller": False},
    "customers": {"is_active": True, "customer_tier": "Bronze", "total_orders": 0, "total_spent": 0},
    "delivery_partners": {"is_active": True, "current_status": "Offline", "total_deliveries": 0,
                          "total_earnings": 0, "bg_verification": False},
    "orders": {"discount_amount": 0, "delivery_fee": 0, "taxes": 0, "is_refunded": False, "refund_amount": 0},
    "deliveries": {"expected_time_mins": 30, "delivery_status": "Pending"},
    "payments": {"payment_status": "Pending", "refund_amount": 0},
    "reviews": {"is_verified": True, "helpful_votes": 0},
    "support_tickets": {"status": "Open", "priority": "Medium", "sla_breached": False},
}


def load_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """Read ``table`` with its declared types; header names choose the columns, empty text is NULL.

    Columns the file lacks get their default; a surrogate key that no file carries is
    the natural key where the table has one row per order.
    """
    spec = TABLES[table]
    source = f"{directory}/{FILES[table]}"
    # Names come from the first header only; types never from the data.
    present = spark.read.option("header", True).option("inferSchema", False).csv(source).columns
    types = {f.name: f.dataType for f in spec.schema}
    text = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in present])
    raw = (
        spark.read.schema(text).option("header", True).option("nullValue", "").option("mode", "FAILFAST")
        .option("enforceSchema", False).csv(source)
    )
    df = derive(raw.select(*[c for c in spec.names if c in present]), table)
    added = {c: F.lit(v).cast(types[c]) for c, v in DEFAULTS.get(table, {}).items() if c not in df.columns}
    if spec.key not in df.columns:
        if table in ("deliveries", "payments", "reviews"):
            added[spec.key] = F.col("order_id")
        elif table == "order_items":
            # Stable across retries, unlike a generated id.
            added[spec.key] = F.xxhash64("order_id", "item_id", "quantity", "unit_price")
    return df.withColumns(added) if added else df


def load_csv(spark: SparkSession, directory: str, *tables: str) -> Marketplace:
    """A marketplace over CSV files; tables without a file stay empty."""
    wanted = tables or ("restaurants", "menu_items", "customers", "delivery_partners", "orders", "order_items",
                        "deliveries", "payments")
    return from_frames(spark, {t: load_table(spark, directory, t) for t in wanted})
