"""Reference rows every deployment starts with."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plateflow.functions.literal import table_of
from plateflow.model import TABLES

# The operating cities (id, name, state).
CITIES = (
    (1, "Mumbai", "Maharashtra"), (2, "Delhi", "Delhi"), (3, "Bangalore", "Karnataka"), (4, "Hyderabad", "Telangana"),
    (5, "Chennai", "Tamil Nadu"), (6, "Pune", "Maharashtra"), (7, "Kolkata", "West Bengal"), (8, "Ahmedabad", "Gujarat"),
    (9, "Jaipur", "Rajasthan"), (10, "Lucknow", "Uttar Pradesh"),
)
# Named areas of the first three cities with their target minutes.
AREAS = {
    "Mumbai": (("Andheri", 28), ("Bandra", 25), ("Dadar", 30), ("Juhu", 27), ("Worli", 22), ("Kurla", 32),
               ("Thane", 38), ("Borivali", 35), ("Navi Mumbai", 40), ("Powai", 26)),
    "Delhi": (("Connaught Place", 24), ("Lajpat Nagar", 28), ("Hauz Khas", 26), ("Noida", 35), ("Gurgaon", 38),
              ("Dwarka", 33), ("Saket", 27), ("Janakpuri", 30), ("Rohini", 32), ("Vasant Kunj", 29)),
    "Bangalore": (("Koramangala", 22), ("Indiranagar", 24), ("HSR Layout", 26), ("Whitefield", 40),
                  ("Jayanagar", 28), ("Electronic City", 42), ("Marathahalli", 35), ("BTM Layout", 27),
                  ("Malleshwaram", 30), ("Yelahanka", 38)),
}
# Code, name, type, value, minimum order, cap, uses, first day, last day, active, audience.
PROMOTIONS = (
    ("WELCOME50", "New User Welcome", "FLAT", 50, 149, 50, None, "2021-01-01", "2026-12-31", True, "NEW_USER"),
    ("SAVE20", "Save 20%", "PERCENT", 20, 199, 80, 100000, "2021-01-01", "2026-12-31", True, "ALL"),
    ("FREEDEL", "Free Delivery", "FREE_DELIVERY", 40, 99, 40, None, "2021-01-01", "2026-12-31", True, "ALL"),
    ("WEEKEND30", "Weekend Special 30%", "PERCENT", 30, 249, 120, 50000, "2021-01-01", "2026-12-31", True, "ALL"),
    ("LOYAL100", "Loyalty Reward ₹100", "FLAT", 100, 399, 100, None, "2022-01-01", "2026-12-31", True, "EXISTING"),
    ("FLASH40", "Flash Sale 40%", "PERCENT", 40, 299, 150, 10000, "2023-01-01", "2023-12-31", False, "ALL"),
    ("DINNER25", "Dinner Rush 25%", "PERCENT", 25, 199, 100, 75000, "2022-01-01", "2026-12-31", True, "ALL"),
    ("NEWREST50", "New Restaurant ₹50", "FLAT", 50, 149, 50, None, "2023-01-01", "2026-12-31", True, "ALL"),
    ("MONSOON20", "Monsoon Special", "PERCENT", 20, 199, 80, 30000, "2023-06-01", "2023-09-30", False, "ALL"),
    ("FESTIVE100", "Festival Bonus", "FLAT", 100, 499, 100, 25000, "2023-10-01", "2023-11-30", False, "ALL"),
)


def cities(spark: SparkSession) -> DataFrame:
    rows = [(i, name, state, "India", "Asia/Kolkata", True, None) for i, name, state in CITIES]
    return table_of(spark, rows, TABLES["cities"].schema)


def fill_zones(places: DataFrame, per_city: int = 10, named: DataFrame | None = None) -> DataFrame:
    """``per_city`` numbered zones for each of ``places`` (city_id, city_name) with 20 + 2z target minutes; ``named``
    (city_name, z, suffix, mins) overrides name and target where it has an entry."""
    grid = places.select("city_id", "city_name", F.explode(F.sequence(F.lit(1), F.lit(per_city))).alias("z"))
    if named is None:
        grid = grid.withColumns({"suffix": F.lit(None).cast("string"), "mins": F.lit(None).cast("int")})
    else:
        grid = grid.join(named, ["city_name", "z"], "left")
    return grid.select(
        ((F.col("city_id") - 1) * per_city + F.col("z")).alias("zone_id"),
        "city_id",
        F.concat("city_name", F.lit(" Zone "), F.col("z").cast("string"), F.coalesce("suffix", F.lit("")))
        .alias("zone_name"),
        F.coalesce("mins", 20 + 2 * F.col("z")).cast("int").alias("avg_delivery_time_mins"),
        F.lit(True).alias("is_active"),
    )


def zones(spark: SparkSession, per_city: int = 10) -> DataFrame:
    """Named areas where known; the other cities get numbered zones with 20 + 2z target minutes."""
    named = [(name, z, f" - {area}", mins) for name, areas in AREAS.items() for z, (area, mins) in enumerate(areas, 1)]
    areas = table_of(spark, named, T.StructType.fromDDL("city_name string, z int, suffix string, mins int"))
    return fill_zones(cities(spark), per_city, areas)


def promotions(spark: SparkSession) -> DataFrame:
    def money(x: int) -> Decimal:
        return Decimal(x).quantize(Decimal("0.01"))

    rows = [
        (i, code, name, kind, money(value), money(least), money(cap), uses, 0,
         date.fromisoformat(first), date.fromisoformat(last), active, who)
        for i, (code, name, kind, value, least, cap, uses, first, last, active, who) in enumerate(PROMOTIONS, 1)
    ]
    return table_of(spark, rows, TABLES["promotions"].schema)


def insert_missing(existing: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """``existing`` plus the rows of ``new`` whose key is not there yet (insert, ignore conflicts)."""
    fresh = new.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*[c for c in existing.columns if c in fresh.columns]),
                                allowMissingColumns=True)


def row_counts(**frames: DataFrame) -> DataFrame:
    """``entity, rows`` of the given tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("entity"), "rows")
             for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
