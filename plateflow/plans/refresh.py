"""Materialised views: written beside the current version, checked, then switched to.

Readers follow a pointer file, so a refresh never blocks or breaks them.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateflow.model import Marketplace
from plateflow.operators import views
from plateflow.plans.partials import Partials, hash_of, table_fingerprint
from plateflow.session import delete, files
from plateflow.sources.store import Stored

# View -> (function, unique key, sort order inside files).
VIEWS = {
    "daily_kpi": (views.daily_kpi, ("day",), ("day",)),
    "restaurant_performance": (views.restaurant_performance, ("restaurant_id",), ("city_name", "revenue_rank")),
    "hourly_demand": (views.hourly_demand, ("day_of_week", "hour_of_day"), ("day_of_week", "hour_of_day")),
    "partner_performance": (views.partner_performance, ("partner_id",), ("partner_id",)),
    "customer_rfm": (views.customer_rfm, ("customer_id",), ("rfm_segment", "customer_id")),
}
# View -> what it is made of where monthly partials are kept, and from which facts and tables.
FROM_PARTIALS = {
    "daily_kpi": (lambda p, m, as_of: views.daily_rows(p.read("days")), ("orders",)),
    "restaurant_performance": (lambda p, m, as_of: views.restaurant_rows(m, _sold(p), _summed(
        p.read("ratings"), "restaurant_id", "reviews", "food", "n_food", "overall", "n_overall")),
        ("orders", "reviews", "restaurants", "cities")),
    "hourly_demand": (lambda p, m, as_of: views.demand_rows(_summed(
        p.read("cells"), "day_of_week", "orders", "amount", "counted", also="hour_of_day")), ("orders",)),
    "partner_performance": (lambda p, m, as_of: views.partner_rows(m, _summed(
        p.read("trips"), "partner_id", "trips", "done", "mins", "n_mins", "km", "n_km", "earned", "late", "timely")),
        ("deliveries", "delivery_partners", "cities", "zones")),
    "customer_rfm": (lambda p, m, as_of: views.rfm_rows(m, p.read("spend").groupBy("customer_id").agg(
        F.max("last").alias("last"), F.sum("orders").alias("orders"), F.sum("amount").alias("amount")), as_of),
        ("orders", "customers")),
}


def _summed(rows: DataFrame, key: str, *figures: str, also: str | None = None) -> DataFrame:
    return rows.groupBy(key, *([also] if also else [])).agg(*[F.sum(f).alias(f) for f in figures])


def _sold(partials: Partials) -> DataFrame:
    """Restaurants' figures from pairs with their customers: first per pair over all months, then per restaurant."""
    figures = ("orders", "done", "gross", "platform", "counted")
    pairs = _summed(partials.read("pairs"), "restaurant_id", *figures, also="customer_id")
    return pairs.groupBy("restaurant_id").agg(*[F.sum(f).alias(f) for f in figures], F.count("customer_id").alias("people"))


# The short refresh after a load leaves the weekly segmentation alone.
AFTER_LOAD = ("daily_kpi", "restaurant_performance", "hourly_demand", "partner_performance")


def _switch(spark: SparkSession, base: str, entry: dict) -> None:
    """Replace the pointer by renaming a finished file over it."""
    fs, path = files(spark, base)
    draft = path(f"{base}/_next-{entry['version']}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(entry), "utf-8"))
    out.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri() if draft.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    option = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    flags = spark.sparkContext._gateway.new_array(option, 1)
    flags[0] = option.OVERWRITE
    context.rename(fs.makeQualified(draft), fs.makeQualified(path(f"{base}/_current")), flags)


def _pointer(spark: SparkSession, base: str) -> dict | None:
    fs, path = files(spark, base)
    current = path(f"{base}/_current")
    if not fs.exists(current):
        return None
    stream = fs.open(current)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def materialise(df: DataFrame, base: str, keys: Iterable[str], order: Iterable[str], as_of: date,
                inputs: str | None = None) -> dict:
    """Write a new version of a view, make sure its key is unique, and point to it.

    Of older versions the one before stays, for those who read it; the others are deleted.
    """
    spark = df.sparkSession
    version = f"v{time.time_ns()}"
    before = _pointer(spark, base)
    # A small view is one file.
    df.hint("rebalance").sortWithinPartitions(*order).write.parquet(f"{base}/{version}")
    groups = spark.read.parquet(f"{base}/{version}").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    seen = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    if seen["most"] > 1:
        delete(spark, f"{base}/{version}")
        raise ValueError(f"{base}: key {tuple(keys)} is not unique in version {version}")
    entry = {"version": version, "rows": seen["rows"], "as_of": as_of.isoformat(), "inputs": inputs}
    _switch(spark, base, entry)
    fs, path = files(spark, base)
    kept = {version, (before or {}).get("version")}
    for status in fs.listStatus(path(base)):
        name = status.getPath().getName()
        if name.startswith("v") and name not in kept:
            fs.delete(status.getPath(), True)
    return entry


def _inputs(partials: Partials, store: str, sources: Iterable[str], as_of: date | None) -> str:
    """What a view depends on: the files of its tables, and the day if it is dated."""
    told = [f"{name} {partials.state(name) or table_fingerprint(partials.spark, f'{store}/{name}')}" for name in sources]
    return hash_of(f"{told} {as_of}")


def refresh(m: Marketplace, as_of: date, path: str, names: Iterable[str] | None = None) -> dict[str, dict]:
    """Bring the named views (all of them by default) up to date, side by side.

    Over a store, the months whose files changed since the last refresh are read once into monthly partials
    and the views put together from these; a view none of whose tables changed stays as it is. Otherwise the
    views are computed from the tables. Every view has its own pointer, so one that fails leaves the others'
    new versions in place.
    """
    wanted = list(names or VIEWS)
    store = m.source.path if isinstance(m.source, Stored) else None
    partials = Partials(m.spark, f"{path}/partials")
    if store is not None:
        partials.update(m, store)

    def one(name: str) -> dict:
        make, keys, order = VIEWS[name]
        if store is None:
            return materialise(make(m, as_of), f"{path}/{name}", keys, order, as_of)
        build, sources = FROM_PARTIALS[name]
        inputs = _inputs(partials, store, sources, as_of if name == "customer_rfm" else None)
        current = _pointer(m.spark, f"{path}/{name}")
        if current and current.get("inputs") == inputs:
            return current
        return materialise(build(partials, m, as_of), f"{path}/{name}", keys, order, as_of, inputs)

    with ThreadPoolExecutor(max(1, len(wanted))) as pool:
        return dict(zip(wanted, pool.map(one, wanted), strict=True))


def attach_views(m: Marketplace, path: str) -> Marketplace:
    """Let the operators of ``m`` read the stored views and counts under ``path``."""
    for name in VIEWS:
        entry = _pointer(m.spark, f"{path}/{name}")
        if entry:
            m.stored[name] = (date.fromisoformat(entry["as_of"]),
                              m.spark.read.parquet(f"{path}/{name}/{entry['version']}"))
    partials = Partials(m.spark, f"{path}/partials")
    if partials.exist():
        m.stored["delivery_minutes"] = (None, partials.minutes())
        m.stored["customer_months"] = (None, partials.months())
    return m
