"""Monthly partial results from which the views and the retention matrix are put together.

A store keeps facts by the month of their order. Each month's files have a fingerprint; a refresh compares
them with those it saw last, reads the months that differ, in one pass over their orders, and replaces their
partials. Everything else is read from partials:

* ``days``: rows of the daily view,
* ``cells``: orders and money per weekday and hour,
* ``pairs``: orders and money per restaurant and customer, of which distinct customers follow,
* ``spend``: delivered orders, money and last day per customer,
* ``ratings``: reviews per restaurant,
* ``trips``: deliveries per partner,
* ``minutes``: how many completed deliveries took how long, late or not, of which exact percentiles follow.

``months`` holds, per customer and 60 months, a bitmap of the months with a delivered order; changed months
are cleared in it and set again.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plateflow.functions.dates import sunday_zero
from plateflow.functions.exact import count_where
from plateflow.model import Marketplace
from plateflow.operators.common import BITMAP_MONTHS, is_cancelled, is_delivered
from plateflow.session import delete, files

SCHEMAS = {
    "days": "day date, first_at timestamp_ntz, orders long, done long, lost long, people long, places long, gross decimal(24,2), "
            "platform decimal(24,2), discounts decimal(24,2), counted long",
    "cells": "day_of_week int, hour_of_day int, orders long, amount decimal(24,2), counted long",
    "pairs": "restaurant_id long, customer_id long, orders long, done long, gross decimal(24,2), platform decimal(24,2), counted long",
    "spend": "customer_id long, orders long, amount decimal(24,2), last date",
    "ratings": "restaurant_id long, reviews long, food long, n_food long, overall long, n_overall long",
    "trips": "partner_id long, trips long, done long, mins long, n_mins long, km decimal(24,2), n_km long, earned decimal(24,2), "
             "late long, timely long",
    "minutes": "mins int, late boolean, timely boolean, trips long",
}
WORDS = "customer_id long, words array<struct<word:int,bits:long>>"
FROM_ORDERS = ("days", "cells", "pairs", "spend")
FACTS = {"orders": FROM_ORDERS, "reviews": ("ratings",), "deliveries": ("trips", "minutes")}


_STATUS = re.compile(r"path=(?P<path>.*?); isDirectory=(?:true|false); length=(?P<size>\d+);.*?modification_time=(?P<time>\d+)")


def _listed(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """(path, size and time) of the files that match; one call to the file system, one for the result."""
    fs, make = files(spark, pattern)
    found = fs.globStatus(make(pattern))
    told = spark.sparkContext._jvm.org.apache.commons.lang3.ArrayUtils.toString(found) if found is not None else ""
    return [(x["path"], f"{x['size']} {x['time']}") for x in _STATUS.finditer(told)]


def fingerprints(spark: SparkSession, path: str) -> dict[str, str]:
    """Month -> names, sizes and times of a fact's files below ``path``, as a hash; no file is opened."""
    found: dict[str, list[str]] = {}
    for below in ("*", "own_month=*/*"):
        for full, entry in _listed(spark, f"{path}/order_month=*/{below}.parquet"):
            month = full.split("/order_month=")[1].split("/")[0]
            found.setdefault(month, []).append(f"{full.rsplit('/', 1)[1]} {entry}")
    return {month: hash_of("\n".join(sorted(entries))) for month, entries in found.items()}


def table_fingerprint(spark: SparkSession, path: str) -> str:
    """The same of a table without months."""
    return hash_of(str(sorted((full.rsplit("/", 1)[1], entry) for full, entry in _listed(spark, f"{path}/*.parquet"))))


def hash_of(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:16]


class Partials:
    """The partials of one store, in a folder of their own."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self, table: str) -> DataFrame:
        schema = T._parse_datatype_string(SCHEMAS[table] + ", order_month date")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def state(self, fact: str) -> str | None:
        """One hash over the months of a fact that the partials were made from; None if it has no partials."""
        return hash_of(str(sorted(self._seen().get(fact, {}).items()))) if fact in FACTS else None

    def exist(self) -> bool:
        return bool(self._seen())

    def months(self) -> DataFrame:
        """customer_id, words (word, bits; ascending): bit b of word w is month 60 w + b, counted from year 0."""
        return self.spark.read.schema(WORDS).parquet(f"{self.path}/months/{self._seen()['bitmap']}")

    def minutes(self) -> DataFrame:
        """``minutes`` of all months together: as many rows as there are different times and flags."""
        return self.spark.read.schema(SCHEMAS["minutes"]).parquet(f"{self.path}/all_minutes/{self._seen()['counts']}")

    def _seen(self) -> dict:
        fs, make = files(self.spark, self.path)
        target = make(f"{self.path}/_seen")
        if not fs.exists(target):
            return {}
        stream = fs.open(target)
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def _remember(self, seen: dict) -> None:
        fs, make = files(self.spark, self.path)
        out = fs.create(make(f"{self.path}/_seen"), True)
        out.write(bytearray(json.dumps(seen), "utf-8"))
        out.close()

    def update(self, m: Marketplace, store: str) -> dict[str, list[str]]:
        """Bring the partials up to the store's files. Returns, per fact, the months that were read (or are gone).

        What was seen is recorded last, so an update that failed is made again in full.
        """
        seen = self._seen()
        now = {fact: fingerprints(self.spark, f"{store}/{fact}") for fact in FACTS}
        changed = {fact: sorted(month for month in {*now[fact], *seen.get(fact, {})}
                                if now[fact].get(month) != seen.get(fact, {}).get(month)) for fact in FACTS}
        if not any(changed.values()):
            return changed
        for fact, tables in FACTS.items():
            for table in tables if changed[fact] else ():
                if fact in seen:
                    for month in changed[fact]:
                        delete(self.spark, f"{self.path}/{table}/order_month={month}")
                else:
                    delete(self.spark, f"{self.path}/{table}")
                # A table all of whose months are empty can be read as well.
                fs, make = files(self.spark, self.path)
                fs.mkdirs(make(f"{self.path}/{table}"))
        live = {fact: [month for month in changed[fact] if month in now[fact]] for fact in FACTS}
        _together(*[lambda of=getattr(self, f"_of_{fact}"), months=live[fact]: of(m, months) for fact in FACTS if live[fact]])
        made = {"bitmap": seen.get("bitmap"), "counts": seen.get("counts")}
        if changed["orders"] or made["bitmap"] is None:
            made["bitmap"] = self._merge_months(made["bitmap"], changed["orders"])
        if changed["deliveries"] or made["counts"] is None:
            made["counts"] = self._merge_minutes(now["deliveries"])
        self._remember({**now, **made})
        for table, key in (("months", "bitmap"), ("all_minutes", "counts")):
            if seen.get(key) not in (None, made[key]):
                delete(self.spark, f"{self.path}/{table}/{seen[key]}")
        return changed

    def _put(self, table: str, rows: DataFrame) -> None:
        schema = T._parse_datatype_string(SCHEMAS[table])
        columns = [F.col(f.name).cast(f.dataType) for f in schema]
        rows.select("order_month", *columns).hint("rebalance", "order_month").write.mode("append").partitionBy(
            "order_month").parquet(f"{self.path}/{table}")

    def _within(self, df: DataFrame, months: list[str]) -> DataFrame:
        """The rows of these months' folders; that of rows without an order's date has a name of its own."""
        dated = F.col("order_month").isin([date.fromisoformat(x) for x in months if not x.startswith("__")])
        return df.filter(dated | F.col("order_month").isNull() if any(x.startswith("__") for x in months) else dated)

    def _of_orders(self, m: Marketplace, months: list[str]) -> None:
        """One pass over the orders of these months: they are counted under four pairs of keys at once."""
        orders = self._within(m.table("orders", "order_date", "order_timestamp", "order_status", "customer_id", "restaurant_id",
                                      "total_amount", "platform_commission", "discount_amount", "order_month"), months)
        day = F.unix_date("order_date").cast("long")
        keys = F.array(*[F.struct(F.lit(i).alias("kind"), a.cast("long").alias("a"), b.cast("long").alias("b")) for i, (a, b) in enumerate((
            (day, F.col("customer_id")), (day, F.col("restaurant_id")), (F.col("restaurant_id"), F.col("customer_id")),
            (sunday_zero(F.col("order_timestamp")), F.hour("order_timestamp"))))])
        live = ~is_cancelled()
        counted = orders.withColumn("_key", F.explode(keys)).groupBy("order_month", "_key.kind", "_key.a", "_key.b").agg(
            F.count(F.lit(1)).alias("n"), count_where(is_delivered()).alias("done"), count_where(is_cancelled()).alias("lost"),
            count_where(live).alias("live"), F.sum("total_amount").alias("gross"),
            F.sum(F.when(live, F.col("total_amount"))).alias("live_gross"), F.count(F.when(live, F.col("total_amount"))).alias("live_n"),
            F.sum(F.when(is_delivered(), F.col("total_amount"))).alias("done_gross"),
            F.sum("platform_commission").alias("platform"), F.sum(F.when(live, F.col("platform_commission"))).alias("live_platform"),
            F.sum("discount_amount").alias("discounts"), F.min("order_timestamp").alias("first_at"), F.count("total_amount").alias("counted"),
            F.max(F.when(is_delivered(), F.col("order_date"))).alias("last"))
        scratch = f"{self.path}/pass"
        counted.write.mode("overwrite").partitionBy("kind").parquet(scratch)
        by = {k: self.spark.read.schema(counted.schema).parquet(scratch).filter(F.col("kind") == k) for k in range(4)}
        people = by[0].groupBy("order_month", F.date_from_unix_date(F.col("a").cast("int")).alias("day")).agg(
            F.min("first_at").alias("first_at"), F.sum("n").alias("orders"), F.sum("done").alias("done"), F.sum("lost").alias("lost"),
            F.count("b").alias("people"), F.sum("gross").alias("gross"), F.sum("platform").alias("platform"),
            F.sum("discounts").alias("discounts"), F.sum("counted").alias("counted"))
        places = by[1].groupBy(F.date_from_unix_date(F.col("a").cast("int")).alias("day")).agg(F.count("b").alias("places"))
        cells = by[3].filter("live > 0").select(
            "order_month", F.col("a").alias("day_of_week"), F.col("b").alias("hour_of_day"), F.col("live").alias("orders"),
            F.col("live_gross").alias("amount"), F.col("live_n").alias("counted"))
        pairs = by[2].filter("live > 0").select(
            "order_month", F.col("a").alias("restaurant_id"), F.col("b").alias("customer_id"), F.col("live").alias("orders"), "done",
            F.col("live_gross").alias("gross"), F.col("live_platform").alias("platform"), F.col("live_n").alias("counted"))
        spend = by[0].filter("done > 0").groupBy("order_month", F.col("b").alias("customer_id")).agg(
            F.sum("done").alias("orders"), F.sum("done_gross").alias("amount"), F.max("last").alias("last"))
        _together(lambda: self._put("days", people.join(places, "day")), lambda: self._put("cells", cells),
                  lambda: self._put("pairs", pairs), lambda: self._put("spend", spend))
        delete(self.spark, scratch)

    def _of_reviews(self, m: Marketplace, months: list[str]) -> None:
        rows = self._within(m.table("reviews", "restaurant_id", "food_rating", "overall_rating", "order_month"), months)
        self._put("ratings", rows.groupBy("order_month", "restaurant_id").agg(
            F.count(F.lit(1)).alias("reviews"), F.sum("food_rating").alias("food"), F.count("food_rating").alias("n_food"),
            F.sum("overall_rating").alias("overall"), F.count("overall_rating").alias("n_overall")))

    def _of_deliveries(self, m: Marketplace, months: list[str]) -> None:
        rows = self._within(m.table("deliveries", "partner_id", "delivery_id", "delivery_status", "actual_time_mins", "distance_km",
                                    "partner_earnings", "sla_breached", "on_time", "order_month"), months)
        done = F.col("delivery_status") == "Delivered"
        trips = rows.filter("partner_id is not null").groupBy("order_month", "partner_id").agg(
            F.count("delivery_id").alias("trips"), count_where(done).alias("done"), F.sum("actual_time_mins").alias("mins"),
            F.count("actual_time_mins").alias("n_mins"), F.sum("distance_km").alias("km"), F.count("distance_km").alias("n_km"),
            F.sum("partner_earnings").alias("earned"), count_where(F.col("sla_breached")).alias("late"),
            count_where(F.col("on_time")).alias("timely"))
        minutes = rows.filter(done & F.col("actual_time_mins").isNotNull()).groupBy(
            "order_month", F.col("actual_time_mins").alias("mins"), F.col("sla_breached").alias("late"),
            F.col("on_time").alias("timely")).agg(F.count(F.lit(1)).alias("trips"))
        _together(lambda: self._put("trips", trips), lambda: self._put("minutes", minutes))

    def _merge_months(self, old: str | None, changed: list[str]) -> str:
        """A new version of the bitmap: changed months cleared, then set from their partials; the other months are not read."""
        index = [month_index(date.fromisoformat(x)) for x in changed if not x.startswith("__")]
        new = self._within(self.read("spend"), changed).filter("order_month is not null").select(
            "customer_id", _index(F.col("order_month")).alias("i"))
        bits = new.groupBy("customer_id", _div(F.col("i")).alias("word")).agg(F.bit_or(_bit(F.col("i") % BITMAP_MONTHS)).alias("bits"))
        if old is not None:
            keep = F.lit(-1).cast("long")
            for word in sorted({i // BITMAP_MONTHS for i in index}):
                mask = sum(1 << (i % BITMAP_MONTHS) for i in index if i // BITMAP_MONTHS == word)
                keep = F.when(F.col("word") == word, F.lit(~mask).cast("long")).otherwise(keep)
            before = self.months().select("customer_id", F.explode("words").alias("w")).select("customer_id", "w.*")
            before = before.withColumn("bits", F.col("bits").bitwiseAND(keep))
            bits = before.unionByName(bits).groupBy("customer_id", "word").agg(F.bit_or("bits").alias("bits")).filter("bits != 0")
        version = hash_of(f"{old} {changed} {json.dumps(self._seen())}")
        # One row a customer, so that reading needs no grouping.
        words = F.sort_array(F.collect_list(F.struct(F.col("word").cast("int").alias("word"), "bits"))).alias("words")
        bits.groupBy("customer_id").agg(words).write.mode("overwrite").parquet(f"{self.path}/months/{version}")
        return version

    def _merge_minutes(self, now: dict[str, str]) -> str:
        """A new version of the counts over all months, from the months' counts."""
        version = hash_of(str(sorted(now.items())))
        rows = self.read("minutes").groupBy("mins", "late", "timely").agg(F.sum("trips").alias("trips"))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/all_minutes/{version}")
        return version


def _together(*jobs: Callable[[], None]) -> None:
    """Run jobs side by side; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def month_index(month: date) -> int:
    return month.year * 12 + month.month - 1


def _index(month: Column) -> Column:
    return F.year(month) * 12 + F.month(month) - 1


def _div(index: Column) -> Column:
    return F.call_function("div", index, F.lit(BITMAP_MONTHS)).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
