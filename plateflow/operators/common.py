"""Building blocks used by several operator families."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plateflow.functions.dates import month_of, months_apart
from plateflow.model import Marketplace


def is_delivered() -> Column:
    return F.col("order_status") == "Delivered"


def is_cancelled() -> Column:
    return F.col("order_status") == "Cancelled"


def delivered(m: Marketplace, *columns: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """Delivered orders with the given columns."""
    extra = () if "order_status" in columns else ("order_status",)
    return m.orders(*columns, *extra, since=since, until=until).filter(is_delivered()).drop(*extra)


def everything() -> W:
    """A window over a whole frame; only for frames of bounded size (days, months, hours, segments)."""
    return W.partitionBy(F.lit(0))


def trailing(order: str, rows: int, window: W | None = None) -> W:
    """The current row and the ``rows`` before it. Frames count rows, so missing days widen them."""
    return (window or everything()).orderBy(order).rowsBetween(-rows, 0)


def upto(order: str, window: W | None = None) -> W:
    return (window or everything()).orderBy(order).rowsBetween(W.unboundedPreceding, 0)


def truncated_growth(current: Column, previous: Column) -> Column:
    """Growth of two counts whose division drops the fraction before the factor 100 is applied."""
    step = F.call_function("div", current - previous, F.nullif(previous, F.lit(0).cast("long")))
    return (step * 100).cast("decimal(20,1)")


def activity_months(m: Marketplace, only_delivered: bool = True, cohort: date | None = None,
                    max_month: int | None = None) -> DataFrame:
    """``customer_id, month, cohort, month_number``: one row per customer and active month.

    With a ``cohort`` (its first day) only that one, from the orders up to its ``max_month``-th month.
    """
    until = None
    if cohort is not None and max_month is not None:
        months = cohort.year * 12 + cohort.month + max_month
        until = date(months // 12, months % 12 + 1, 1)
    if only_delivered:
        orders = delivered(m, "customer_id", "order_date", until=until)
    else:
        orders = m.orders("customer_id", "order_date", until=until)
    # The set of months of a customer is as long as the calendar at most, and it is merged
    # map-side: one shuffle gives the cohort and the months, where distinct rows and a
    # window over them would take two.
    per = orders.groupBy("customer_id").agg(F.collect_set(month_of(F.col("order_date"))).alias("_months"))
    if cohort is not None:
        per = per.filter(F.array_min("_months") == F.lit(cohort))
    rows = per.select("customer_id", F.array_min("_months").alias("cohort"), F.explode("_months").alias("month"))
    return rows.withColumn("month_number", months_apart(F.col("month"), F.col("cohort")))


#: Months in a word of the bitmap of active months.
BITMAP_MONTHS = 60


def cohorts_of(months: DataFrame, max_month: int) -> DataFrame:
    """cohort, month_number, active_customers, cohort_size from the bitmap, by shifting and counting bits.

    A customer's first set bit is the cohort; the bits from there on, of two words at most, say in which of
    the following months (up to 59) the customer was active.
    """
    words = months.select(F.col("words")[0].alias("one"), F.try_element_at("words", F.lit(2)).alias("two"))
    # The lowest set bit, by counting the bits below it.
    first = F.bit_count(F.col("one.bits").bitwiseAND(-F.col("one.bits")) - F.lit(1)).cast("int")
    later = F.when(F.col("two.word") == F.col("one.word") + 1, F.col("two.bits")).otherwise(F.lit(0).cast("long"))
    window = F.call_function("shiftrightunsigned", F.col("one.bits"), first).bitwiseOR(
        F.when(first > 0, F.call_function("shiftleft", later, F.lit(BITMAP_MONTHS) - first)).otherwise(F.lit(0).cast("long")))
    start = F.col("one.word") * BITMAP_MONTHS + first
    rows = words.select(F.make_date(F.call_function("div", start, F.lit(12)).cast("int"), (start % 12 + 1).cast("int"), F.lit(1)).alias("cohort"),
                        window.alias("w"))
    active = [F.sum(F.shiftrightunsigned("w", n).bitwiseAND(F.lit(1))).alias(f"m{n}") for n in range(max_month + 1)]
    counted = rows.groupBy("cohort").agg(*active)
    entries = F.array(*[F.struct(F.lit(n).alias("month_number"), F.col(f"m{n}").alias("active_customers")) for n in range(max_month + 1)])
    return counted.select("cohort", F.col("m0").alias("cohort_size"), F.explode(entries).alias("e")).select(
        "cohort", "e.month_number", "e.active_customers", "cohort_size").filter("active_customers > 0")


def cohort_counts(m: Marketplace, max_month: int | None, only_delivered: bool = True,
                  cohort: date | None = None) -> DataFrame:
    """``cohort, month_number, active_customers, cohort_size``, of one cohort if it is given.

    Everyone is active in month 0 of their own cohort, so the size needs no second pass. Where the months of
    every customer are stored as bits, they are read instead of orders.
    """
    kept = m.stored.get("customer_months")
    if kept is not None and only_delivered and max_month is not None and max_month < BITMAP_MONTHS:
        found = cohorts_of(kept[1], max_month)
        return found if cohort is None else found.filter(F.col("cohort") == F.lit(cohort))
    counts = activity_months(m, only_delivered, cohort, max_month)
    if max_month is not None:
        counts = counts.filter(F.col("month_number") <= max_month)
    counts = counts.groupBy("cohort", "month_number").agg(F.count(F.lit(1)).alias("active_customers"))
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(W.partitionBy("cohort"))
    return counts.withColumn("cohort_size", size)


def places(m: Marketplace, *columns: str) -> DataFrame:
    """Restaurants with the name of their city."""
    rest = m.restaurants(*dict.fromkeys(("restaurant_id", "city_id", *[c for c in columns if c != "city_name"])))
    return rest.join(m.cities("city_id", "city_name"), "city_id").select(
        *dict.fromkeys(("restaurant_id", *columns, "city_name")))


def zone_names(m: Marketplace, *columns: str) -> DataFrame:
    zones = m.zones(*dict.fromkeys(("zone_id", "city_id", "zone_name", *columns)))
    return zones.join(m.cities("city_id", "city_name"), "city_id").select(
        *dict.fromkeys(("zone_id", "zone_name", "city_name", *columns)))


def catalog(m: Marketplace, *columns: str) -> DataFrame:
    """Menu items with their restaurant's name and cuisine (joined among dimensions, before any fact)."""
    items = m.menu_items(*dict.fromkeys(("item_id", "restaurant_id", "item_name", *columns)))
    rest = m.restaurants("restaurant_id", "restaurant_name", "cuisine_type")
    return items.join(rest, "restaurant_id").drop("restaurant_id")


def distinct(column: Column | str, approximate: bool = False) -> Column:
    """Distinct values, exact unless told otherwise (a sketch needs no second shuffle of the values)."""
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def minutes_at(column: str, point: float, approximate: bool = False) -> Column:
    """Percentile of whole minutes; exact, with one counter per distinct minute, unless told otherwise."""
    return F.expr(f"percentile{'_approx' if approximate else ''}({column}, {point})")


def minutes_at_all(column: str, points: Sequence[float], approximate: bool = False) -> Column:
    """An array of percentiles of whole minutes from one set of counters."""
    listed = ", ".join(map(str, points))
    return F.expr(f"percentile{'_approx' if approximate else ''}({column}, array({listed}))")
