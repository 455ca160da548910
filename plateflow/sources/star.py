"""The benchmark star (customers, suppliers, orders, line items) read as a marketplace.

Suppliers become restaurants, line items become order items, and everything the star
lacks follows from the keys by fixed arithmetic, so that a second engine can derive
the same marketplace. A table joins line items or customers only for columns that
need them: an operator reading order dates and statuses scans ``orders`` alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from plateflow.functions.dates import between_dates
from plateflow.model import ISSUES, PAYMENT_METHODS, PRIORITIES, TABLES, TICKET_SLA_HOURS, TICKET_STATUSES, \
    TIER_FLOORS, Marketplace
from plateflow.sources import seeds

# Fixed values shared with the SQL form of this mapping.
CUISINES = ("North Indian", "South Indian", "Chinese", "Italian", "Mexican", "Fast Food", "Pizza", "Biryani",
            "Rolls & Wraps", "Desserts")
COMMISSIONS = (15, 18, 20, 22, 25, 30)
FEES = (0, 29, 39, 49)
CHANNELS = ("App", "Web", "Phone")
VEHICLES = ("Motorbike", "Bicycle", "Scooter", "Car")
REASONS = ("Changed mind", "Ordered by mistake", "Restaurant too busy", "Estimated time too long",
           "Found better option", "Payment failed", "No delivery partner available", "Restaurant closed")
STAR_ISSUES = tuple(i for i in ISSUES if i != "App Issue")
# Item ids join restaurant and part numbers; parts stay below this factor.
ITEM_FACTOR = 10_000_000_000

# Columns of the star tables; declaring them spares a look into the files for every table.
STAR = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _pick(values: Iterable, index: str) -> str:
    """SQL for the value at a zero-based index."""
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"element_at(array({items}), cast({index} + 1 as int))"


def _after(ts: str, **parts: str) -> str:
    """SQL for a time plus days, hours, mins or secs."""
    units = [f"cast({parts.get(u, '0')} as int)" for u in ("days", "hours", "mins")]
    return f"({ts} + make_dt_interval({', '.join(units)}, cast({parts.get('secs', '0')} as decimal(18,6))))"


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{sql} as {name}" for name, sql in columns.items()]


class _Star:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._pinned: DataFrame | None = None
        self._tables: dict[str, DataFrame] = {}

    def pin(self, path: str) -> None:
        """Write the joined orders once, for jobs that derive many tables from them."""
        everything = set(TABLES["orders"].names) | {"_lined", "_qty", "_tax"}
        self.orders(everything, None, None).select(*sorted(everything)).write.mode("overwrite").parquet(path)
        self._pinned = self.spark.read.parquet(path)

    def raw(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(STAR[name]).parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    def provide(self, table: str, columns: list[str], since: date | None, until: date | None) -> DataFrame:
        return getattr(self, table)(set(columns), since, until)

    # ---- bounded reference tables ------------------------------------------------
    def cities(self, need: set[str], *_: object) -> DataFrame:
        places = self.raw("nation")
        if "state" in need:
            places = places.join(self.raw("region"), F.expr("n_regionkey = r_regionkey"))
        return places.selectExpr(
            "n_nationkey as city_id", "n_name as city_name", *(["r_name as state"] if "state" in need else []),
            "'India' as country", "'Asia/Kolkata' as timezone", "true as is_active", "null as launch_date")

    def zones(self, need: set[str], *_: object) -> DataFrame:
        grid = self.raw("nation").selectExpr("cast(n_nationkey as long) as city_id", "n_name", "explode(array(1, 2)) as z")
        return grid.selectExpr(
            "city_id * 10 + z as zone_id", "city_id", "concat(n_name, ' Zone ', z) as zone_name",
            "concat('Z', city_id * 10 + z) as zone_code", "null as latitude", "null as longitude",
            "20 + 2 * z as avg_delivery_time_mins", "true as is_active")

    def promotions(self, need: set[str], *_: object) -> DataFrame:
        base = seeds.promotions(self.spark)
        if not need & {"current_uses", "is_active"}:
            return base
        used = self.orders({"promotion_id"}, None, None).filter("promotion_id is not null").groupBy(
            "promotion_id").agg(F.expr("count(*) as _uses"))
        kept = [c for c in TABLES["promotions"].names if c not in ("current_uses", "is_active")]
        return base.join(used, "promotion_id", "left").selectExpr(
            *kept, "coalesce(_uses, 0) as current_uses",
            "is_active and (max_uses is null or coalesce(_uses, 0) < max_uses) as is_active")

    # ---- people and places ---------------------------------------------------------
    def restaurants(self, need: set[str], *_: object) -> DataFrame:
        columns = {
            "restaurant_id": "s_suppkey", "restaurant_name": "s_name",
            "cuisine_type": _pick(CUISINES, "s_suppkey % 10"), "city_id": "cast(s_nationkey as long)",
            "zone_id": "s_nationkey * 10L + 1 + s_suppkey % 2", "owner_name": "null",
            "phone": "concat('+91', s_suppkey)", "email": "concat('kitchen', s_suppkey, '@example.com')",
            "address": "null", "latitude": "null", "longitude": "null",
            "rating": "2.50 + cast(s_suppkey * 37 % 251 as decimal(3,0)) * 0.01", "avg_delivery_time_mins": "30",
            "min_order_amount": "149.00", "commission_rate": _pick(COMMISSIONS, "s_suppkey % 6"),
            "is_active": "s_suppkey % 20 != 0", "is_pure_veg": "s_suppkey % 7 = 0",
            "joining_date": "date_add(date'1995-01-01', cast(s_suppkey * 13 % 365 as int))",
        }
        df = self.raw("supplier").selectExpr(*_named(columns))
        if need & {"total_orders", "total_revenue"}:
            totals = (
                self.orders({"restaurant_id", "order_status", "total_amount"}, None, None)
                .filter("order_status = 'Delivered'").groupBy("restaurant_id")
                .agg(F.expr("count(*) as _n"), F.expr("sum(total_amount) as _sum"))
            )
            df = df.join(totals, "restaurant_id", "left").selectExpr(
                "*", "coalesce(_n, 0) as total_orders", "coalesce(_sum, 0) as total_revenue")
        if "total_ratings" in need:
            rated = self.reviews({"restaurant_id"}).groupBy("restaurant_id").agg(F.expr("count(*) as _ratings"))
            df = df.join(rated, "restaurant_id", "left").selectExpr("*", "coalesce(_ratings, 0) as total_ratings")
        return df

    def menu_categories(self, need: set[str], *_: object) -> DataFrame:
        grid = self.raw("supplier").selectExpr("s_suppkey as restaurant_id", "explode(array(1, 2)) as k")
        return grid.selectExpr(
            "restaurant_id * 10 + k as category_id", "restaurant_id",
            f"{_pick(('Mains', 'Sides'), 'k - 1')} as category_name", "k as display_order", "true as is_active")

    def menu_items(self, need: set[str], *_: object) -> DataFrame:
        sold = self.raw("lineitem").select("l_suppkey", "l_partkey").distinct()
        named = need & {"item_name", "price"}
        if named:
            sold = sold.join(self.raw("part").select("p_partkey", "p_name", "p_retailprice"),
                             F.expr("l_partkey = p_partkey"))
        columns = {
            "item_id": f"l_suppkey * {ITEM_FACTOR}L + l_partkey", "restaurant_id": "l_suppkey",
            "category_id": "l_suppkey * 10 + 1 + l_partkey % 2", "description": "null",
            "is_available": "l_partkey % 11 != 0", "is_vegetarian": "l_partkey % 2 = 0",
            "calories": "l_partkey % 600 + 100", "preparation_time_mins": "15", "is_bestseller": "l_partkey % 7 = 0",
        } | ({"item_name": "p_name", "price": "p_retailprice"} if named else {})
        return sold.selectExpr(*_named(columns))

    def customers(self, need: set[str], *_: object) -> DataFrame:
        columns = {
            "customer_id": "c_custkey", "customer_name": "c_name",
            "email": "concat('user', c_custkey, '@example.com')", "phone": "concat('+91', c_custkey)",
            "city_id": "cast(c_nationkey as long)",
            "registration_date": _after("timestamp_ntz'1995-01-01 00:00:00'", days="c_custkey * 7 % 2000"),
            "is_active": "c_custkey % 25 != 0", "referral_code": "concat('REF', c_custkey)",
            "acquisition_channel": "c_mktsegment",
        }
        df = self.raw("customer").selectExpr(*_named(columns))
        if need & {"customer_tier", "total_orders", "total_spent", "last_order_date"}:
            timed = "last_order_date" in need
            wanted = {"customer_id", "order_status", "total_amount"} | ({"delivered_at"} if timed else set())
            sums = ["count(*) as _n", "sum(total_amount) as _sum"] + (["max(delivered_at) as last_order_date"] if timed else [])
            totals = self.orders(wanted, None, None).filter("order_status = 'Delivered'").groupBy("customer_id").agg(
                *[F.expr(s) for s in sums])
            floors = " ".join(f"when _sum >= {floor} then '{tier}'" for tier, floor in TIER_FLOORS)
            df = df.join(totals, "customer_id", "left").selectExpr(
                "*", "coalesce(_n, 0) as total_orders", "coalesce(_sum, 0) as total_spent",
                f"case {floors} else 'Bronze' end as customer_tier")
        return df

    def customer_addresses(self, need: set[str], *_: object) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey as address_id", "c_custkey as customer_id",
            f"{_pick(('Home', 'Work', 'Other'), 'c_custkey % 3')} as address_label", "null as street_address",
            "null as area", "c_nationkey as city_id", "null as latitude", "null as longitude", "true as is_default")

    def delivery_partners(self, need: set[str], *_: object) -> DataFrame:
        grid = self.zones({"zone_id", "city_id"}).selectExpr("zone_id", "city_id", "explode(sequence(0, 3)) as k")
        df = grid.selectExpr("zone_id", "city_id", "k", "zone_id * 10 + k as partner_id").selectExpr(
            "partner_id", "zone_id", "city_id", "concat('Partner ', partner_id) as partner_name",
            "concat('+91', partner_id) as phone", "null as email", f"{_pick(VEHICLES, 'k')} as vehicle_type",
            "partner_id % 12 != 0 as is_active",
            f"{_pick(('Available', 'Offline', 'On Delivery'), 'partner_id % 3')} as current_status",
            "3.00 + cast(partner_id * 17 % 201 as decimal(3,0)) * 0.01 as rating",
            "date_add(date'1995-01-01', cast(partner_id * 11 % 700 as int)) as joining_date",
            "partner_id % 5 != 0 as bg_verification")
        if need & {"total_deliveries", "total_earnings"}:
            done = self.deliveries({"partner_id", "delivery_status", "partner_earnings"}).filter(
                "delivery_status = 'Delivered'").groupBy("partner_id").agg(
                F.expr("count(*) as _n"), F.expr("sum(partner_earnings) as _sum"))
            df = df.join(done, "partner_id", "left").selectExpr(
                "*", "coalesce(_n, 0) as total_deliveries", "coalesce(_sum, 0) as total_earnings")
        return df

    # ---- facts ---------------------------------------------------------------------
    def _first_lines(self) -> DataFrame:
        """One line item per order: the smallest by all its fields, hence the same on every run."""
        line = "min(struct(l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax)) as line"
        return self.raw("lineitem").groupBy("l_orderkey").agg(F.expr(line)).selectExpr(
            "l_orderkey", "line.l_suppkey as _supp", "cast(line.l_quantity as int) as _qty",
            "cast(round(line.l_discount * 100) as decimal(3,0)) as _disc",
            "cast(round(line.l_tax * 100) as decimal(3,0)) as _tax")

    _LINE = {"restaurant_id", "discount_amount", "taxes", "total_amount", "platform_commission", "refund_amount",
             "delivered_at", "_qty", "_tax", "_lined"}
    _MONEY = {"discount_amount", "taxes", "total_amount", "platform_commission", "refund_amount"}
    # Expressions over the raw columns; ts is the order time, st the status.
    _ORDER = {
        "order_id": "o_orderkey", "customer_id": "o_custkey", "address_id": "o_custkey", "order_timestamp": "ts",
        "order_date": "cast(o_orderdate as date)", "order_status": "st",
        "order_channel": _pick(CHANNELS, "o_orderkey div 3 % 3"),
        "payment_method": _pick(PAYMENT_METHODS, "o_orderkey div 4 % 6"),
        "promotion_id": "case when o_orderkey % 5 = 0 then o_orderkey div 5 % 10 + 1 end",
        "cancellation_reason": "case when st = 'Cancelled' and o_orderkey % 400 != 1 then "
                               + _pick(REASONS, "o_orderkey div 3 % 8") + " end",
        "confirmed_at": f"case when st != 'Cancelled' and o_orderkey % 50 > 0 then {_after('ts', mins='2')} end",
        "prepared_at": f"case when st != 'Cancelled' and o_orderkey % 50 > 1 then {_after('ts', mins='8')} end",
        "picked_up_at": f"case when st != 'Cancelled' and o_orderkey % 50 > 2 then {_after('ts', mins='9')} end",
        "cancelled_at": f"case when st = 'Cancelled' then {_after('ts', mins='o_orderkey % 20 + 2')} end",
        "delivered_at": f"case when st = 'Delivered' then {_after('ts', mins='coalesce(_qty + 10, 40)')} end",
        "is_refunded": "st = 'Cancelled' and o_orderkey % 2 = 0",
        "subtotal_amount": "cast(o_totalprice as decimal(10,2))",
        "delivery_fee": f"cast({_pick(FEES, 'o_orderkey % 4')} as decimal(6,2))", "special_instructions": "null",
        "zone_id": "c_nationkey * 10L + 1 + o_orderkey % 2", "restaurant_id": "coalesce(_supp, o_orderkey % 10)",
        "_qty": "_qty", "_tax": "_tax", "_lined": "l_orderkey is not null",
    }

    def orders(self, need: set[str], since: date | None, until: date | None) -> DataFrame:
        if self._pinned is not None:
            return between_dates(self._pinned, since, until)
        df = self.raw("orders")
        # o_orderdate carries no time, so these bounds reach the file statistics.
        if since is not None:
            df = df.filter(f"o_orderdate >= timestamp_ntz'{since} 00:00:00'")
        if until is not None:
            df = df.filter(f"o_orderdate < timestamp_ntz'{until} 00:00:00'")
        if need & self._LINE:
            df = df.join(self._first_lines(), F.expr("o_orderkey = l_orderkey"), "left")
        if "zone_id" in need:
            df = df.join(self.raw("customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
        df = df.selectExpr(
            "*", f"{_after('o_orderdate', secs='o_orderkey * 7919 % 86400')} as ts",
            "case when o_orderstatus != 'P' then 'Delivered' when o_orderkey % 3 != 0 then 'Cancelled' "
            "else 'On The Way' end as st")
        if not need & self._MONEY:
            return df.selectExpr(*_named({c: self._ORDER[c] for c in need}))
        plain = (need - self._MONEY) | {"delivery_fee", "restaurant_id", "is_refunded", "subtotal_amount"}
        rate = _pick(COMMISSIONS, "restaurant_id % 6")
        return (
            df.selectExpr("*", *_named({c: self._ORDER[c] for c in plain if c not in ("_qty", "_tax")}),
                          "cast(coalesce(round(cast(o_totalprice as decimal(10,2)) * _disc * 0.01, 2), 0) "
                          "as decimal(8,2)) as discount_amount")
            .selectExpr("*", "cast(round((subtotal_amount - discount_amount) * 0.05, 2) as decimal(8,2)) as taxes")
            .selectExpr("*", "cast(subtotal_amount - discount_amount + delivery_fee + taxes as decimal(10,2)) "
                             "as total_amount")
            .selectExpr(*(plain | ({"discount_amount", "taxes", "total_amount"})),
                        f"cast(round(total_amount * cast({rate} as decimal(3,0)) * 0.01, 2) as decimal(8,2)) "
                        "as platform_commission",
                        "case when is_refunded then total_amount else 0 end as refund_amount")
        )

    def order_items(self, need: set[str], *_: object) -> DataFrame:
        df = self.raw("lineitem")
        columns = {
            "order_item_id": "l_orderkey * 10 + l_linenumber", "order_id": "l_orderkey",
            "item_id": f"l_suppkey * {ITEM_FACTOR}L + l_partkey", "quantity": "cast(l_quantity as int)",
            "special_notes": "null",
        }
        if need & {"unit_price", "item_total"}:
            df = df.join(self.raw("part").selectExpr("p_partkey", "cast(p_retailprice as decimal(8,2)) as price"),
                         F.expr("l_partkey = p_partkey"))
            columns |= {"unit_price": "price", "item_total": "cast(l_quantity as int) * price"}
        return df.selectExpr(*_named(columns))

    def deliveries(self, need: set[str], *_: object) -> DataFrame:
        base = {"order_id", "order_timestamp", "order_status", "_lined", "_qty", "_tax", "delivery_fee"}
        zoned = need & {"partner_id", "expected_time_mins", "expected_delivery_time", "on_time"}
        if zoned:
            base.add("zone_id")
        df = self.orders(base, None, None).filter("order_status != 'Cancelled' and _lined and order_id % 20 != 0")
        ts, mins = "order_timestamp", "25 + zone_id % 10 * 2"
        columns = {
            "delivery_id": "order_id", "order_id": "order_id", "assigned_at": _after(ts, mins="2 + order_id % 5"),
            "restaurant_reached_at": "null", "picked_up_at": _after(ts, mins="9"),
            "delivered_at": _after(ts, mins="_qty + 10"), "actual_time_mins": "_qty + 10", "distance_km": "_tax",
            "delivery_fee": "delivery_fee",
            "delivery_status": "case when order_status = 'Delivered' then 'Delivered' else 'Failed' end",
            "sla_breached": "_qty + 10 > 45",
            "delivery_rating": "case when order_id % 4 != 0 then order_id * 11 % 5 + 1 end",
            "partner_earnings": "cast(round(delivery_fee * 0.7 + _tax * 2, 2) as decimal(6,2))",
        }
        if zoned:
            columns |= {
                "partner_id": "zone_id * 10 + order_id div 2 % 4", "expected_time_mins": mins,
                "expected_delivery_time": _after(ts, mins=mins), "on_time": f"_qty + 10 <= {mins}",
            }
        return df.selectExpr(*_named({c: columns[c] for c in need}))

    def payments(self, need: set[str], *_: object) -> DataFrame:
        base = {"order_id", "order_status", "payment_method", "order_timestamp", "cancelled_at"}
        if need & {"amount", "refund_amount"}:
            base.add("total_amount")
        back = "order_status = 'Cancelled'"
        columns = {
            "payment_id": "order_id", "order_id": "order_id", "amount": "total_amount",
            "payment_method": "payment_method",
            "payment_status": f"case when {back} then 'Refunded' else 'Completed' end",
            "transaction_id": "concat('TXN', lpad(order_id, greatest(10, length(order_id)), '0'))",
            "payment_timestamp": "order_timestamp",
            "refund_amount": f"case when {back} then total_amount else 0 end",
            "refund_timestamp": f"case when {back} then cancelled_at end", "gateway_response": "null",
        }
        return self.orders(base, None, None).selectExpr(*_named({c: columns[c] for c in need}))

    def reviews(self, need: set[str], *_: object) -> DataFrame:
        base = {"order_id", "customer_id", "restaurant_id", "order_status", "order_timestamp", "_lined"}
        if "partner_id" in need:
            base.add("zone_id")
        df = self.orders(base, None, None).filter(
            "order_status = 'Delivered' and order_id % 4 != 0 and restaurant_id % 10 != 9")
        level = _pick((3, 4, 5, 2), "restaurant_id % 4")
        columns = {
            "review_id": "order_id", "order_id": "order_id", "customer_id": "customer_id",
            "restaurant_id": "restaurant_id",
            "partner_id": "case when _lined and order_id % 20 != 0 then zone_id * 10 + order_id div 2 % 4 end",
            "food_rating": f"greatest(1, least(5, {level} + order_id % 3 - 1))",
            "delivery_rating": "case when order_id % 9 != 0 then order_id * 11 % 5 + 1 end",
            "overall_rating": "case when order_id % 10 != 0 then order_id * 13 % 5 + 1 end", "review_text": "null",
            "created_at": _after("order_timestamp", days="1"), "is_verified": "true", "helpful_votes": "order_id % 7",
        }
        return df.selectExpr(*_named({c: columns[c] for c in need}))

    def support_tickets(self, need: set[str], *_: object) -> DataFrame:
        limits = " ".join(f"when priority = '{p}' then {h}" for p, h in TICKET_SLA_HOURS.items())
        return (
            self.orders({"order_id", "customer_id", "order_timestamp"}, None, None).filter("order_id % 12 = 0")
            .selectExpr("*", "order_id div 12 as ticket_id")
            .selectExpr("order_id", "customer_id", "ticket_id", f"{_after('order_timestamp', hours='2')} as created_at",
                        f"{_pick(TICKET_STATUSES, 'ticket_id % 5')} as status",
                        f"{_pick(PRIORITIES, 'ticket_id div 8 % 4')} as priority", "ticket_id % 48 + 1 as _hours")
            .selectExpr(
                "*", f"{_pick(STAR_ISSUES, 'ticket_id % 8')} as issue_type", "null as issue_description",
                f"case when status in ('Resolved', 'Closed') then {_after('created_at', hours='_hours')} end as resolved_at",
                "null as resolution_notes", "concat('A', ticket_id % 9) as agent_id",
                f"coalesce(status in ('Resolved', 'Closed') and _hours > case {limits} end, false) as sla_breached")
        )

    def order_status_history(self, need: set[str], *_: object) -> DataFrame:
        marks = (
            (1, "Placed", "order_timestamp"), (2, "Confirmed", "confirmed_at"),
            (3, "Preparing", _after("confirmed_at", mins="1")), (4, "Ready", "prepared_at"),
            (5, "Picked Up", "picked_up_at"), (6, "On The Way", _after("picked_up_at", mins="1")),
            (7, "Delivered", "delivered_at"), (8, "Cancelled", "cancelled_at"),
        )
        entries = ", ".join(f"struct({i} as i, '{s}' as status, {at} as changed_at)" for i, s, at in marks)
        df = self.orders({"order_id", "order_timestamp", "confirmed_at", "prepared_at", "picked_up_at",
                          "delivered_at", "cancelled_at"}, None, None)
        return df.selectExpr("order_id", f"explode(filter(array({entries}), e -> e.changed_at is not null)) as e").selectExpr(
            "order_id * 10 + e.i as history_id", "order_id", "e.status as status", "e.changed_at as changed_at",
            "'system' as changed_by", "null as notes")


# Day on which every registered query over the star is asked.
AS_OF = date(2001, 8, 2)


def star_market(spark: SparkSession, directory: str) -> Marketplace:
    """The star under ``directory`` as a lazily built marketplace."""
    star = _Star(spark, directory)

    def provide(table: str, columns: list[str], since: date | None, until: date | None, own_since: date | None) -> DataFrame:
        types = {f.name: f.dataType.simpleString() for f in TABLES[table].schema}
        df = star.provide(table, columns, since, until)
        return df.selectExpr(*[f"cast({c} as {types[c]}) as {c}" for c in columns])

    market = Marketplace(spark, provide)
    market.source = star
    return market
