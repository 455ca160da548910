"""Tables of the marketplace: schemas, constraints, and the accessor every operator uses."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plateflow.functions.dates import between_dates, between_months, month_of

# States, categories and limits of the marketplace.
ORDER_STATUSES = ("Placed", "Confirmed", "Preparing", "Ready", "Picked Up", "On The Way", "Delivered", "Cancelled")
DELIVERY_STATUSES = ("Pending", "Assigned", "En Route to Restaurant", "Picked Up", "En Route to Customer",
                     "Delivered", "Failed", "Cancelled")
PAYMENT_STATUSES = ("Pending", "Completed", "Failed", "Refunded", "Partially Refunded")
PAYMENT_METHODS = ("UPI", "Credit Card", "Debit Card", "Cash", "Wallet", "NetBanking")
CHANNELS = ("App", "Web", "Phone")
VEHICLES = ("Bicycle", "Motorbike", "Scooter", "Car")
PARTNER_STATES = ("Offline", "Available", "On Delivery")
TIERS = ("Bronze", "Silver", "Gold", "Platinum")
PROMO_TYPES = ("FLAT", "PERCENT", "FREE_DELIVERY", "BOGO")
PROMO_AUDIENCES = ("ALL", "NEW_USER", "EXISTING", "SPECIFIC_REST")
ADDRESS_LABELS = ("Home", "Work", "Other")
ISSUES = ("Wrong Item", "Missing Item", "Late Delivery", "Cancelled by Restaurant", "Payment Issue",
          "Refund Request", "App Issue", "Quality Issue", "Other")
TICKET_STATUSES = ("Open", "In Progress", "Resolved", "Closed", "Escalated")
PRIORITIES = ("Low", "Medium", "High", "Critical")
ORDER_MOVES = {
    "Placed": ("Confirmed", "Cancelled"), "Confirmed": ("Preparing", "Cancelled"),
    "Preparing": ("Ready", "Cancelled"), "Ready": ("Picked Up",), "Picked Up": ("On The Way",),
    "On The Way": ("Delivered",), "Delivered": (), "Cancelled": (),
}
DELIVERY_MOVES = {
    "Pending": ("Assigned",), "Assigned": ("En Route to Restaurant", "Cancelled"),
    "En Route to Restaurant": ("Picked Up",), "Picked Up": ("En Route to Customer",),
    "En Route to Customer": ("Delivered", "Failed"), "Delivered": (), "Failed": (), "Cancelled": (),
}
SLA_MINUTES = 45
TAX_PERCENT = 5
DEFAULT_FEE = 39
TIER_FLOORS = (("Platinum", 10000), ("Gold", 5000), ("Silver", 2000))
TICKET_SLA_HOURS = {"Critical": 2, "High": 8, "Medium": 24}

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "short": T.ShortType(), "str": T.StringType(),
    "bool": T.BooleanType(), "date": T.DateType(), "ts": T.TimestampNTZType(),
}


def _type(name: str) -> T.DataType:
    if name.startswith("dec"):
        precision, scale = name[3:].split(".")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[name]


@dataclass(frozen=True)
class Table:
    """A declared table. Column text is ``name:type``, with ``!`` for NOT NULL."""

    name: str
    columns: str
    key: str
    unique: tuple[tuple[str, ...], ...] = ()
    refs: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float | None, float | None, bool]] = field(default_factory=dict)
    values: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @cached_property
    def schema(self) -> T.StructType:
        fields = []
        for item in self.columns.split():
            name, kind = item.rstrip("!").split(":")
            fields.append(T.StructField(name, _type(kind), not item.endswith("!")))
        return T.StructType(fields)

    @property
    def names(self) -> list[str]:
        return self.schema.names


# (low, high, low_is_open) for the range rules.
_STARS = (1, 5, False)
_RATING = (0, 5, False)
_POSITIVE = (0, None, True)

TABLES: dict[str, Table] = {t.name: t for t in (
    Table("cities",
          "city_id:long! city_name:str! state:str! country:str! timezone:str! is_active:bool! launch_date:date",
          "city_id"),
    Table("zones",
          "zone_id:long! city_id:long! zone_name:str! zone_code:str latitude:dec9.6 longitude:dec9.6 "
          "avg_delivery_time_mins:int is_active:bool!",
          "zone_id", refs={"city_id": ("cities", "city_id")}),
    Table("restaurants",
          "restaurant_id:long! restaurant_name:str! cuisine_type:str! city_id:long! zone_id:long owner_name:str "
          "phone:str email:str address:str latitude:dec9.6 longitude:dec9.6 rating:dec3.2 total_ratings:long! "
          "avg_delivery_time_mins:int min_order_amount:dec8.2 commission_rate:dec5.2 is_active:bool! "
          "is_pure_veg:bool! joining_date:date! total_orders:long! total_revenue:dec24.2!",
          "restaurant_id", unique=(("email",),),
          refs={"city_id": ("cities", "city_id"), "zone_id": ("zones", "zone_id")},
          ranges={"rating": _RATING, "commission_rate": (5, 40, False)}),
    Table("menu_categories",
          "category_id:long! restaurant_id:long! category_name:str! display_order:int is_active:bool!",
          "category_id", refs={"restaurant_id": ("restaurants", "restaurant_id")}),
    Table("menu_items",
          "item_id:long! restaurant_id:long! category_id:long item_name:str! description:str price:dec8.2! "
          "is_available:bool! is_vegetarian:bool! calories:int preparation_time_mins:int is_bestseller:bool!",
          "item_id",
          refs={"restaurant_id": ("restaurants", "restaurant_id"), "category_id": ("menu_categories", "category_id")},
          ranges={"price": _POSITIVE, "calories": _POSITIVE}),
    Table("customers",
          "customer_id:long! customer_name:str! email:str! phone:str city_id:long registration_date:ts! "
          "last_order_date:ts is_active:bool! customer_tier:str! total_orders:long! total_spent:dec24.2! "
          "referral_code:str acquisition_channel:str",
          "customer_id", unique=(("email",), ("phone",)), refs={"city_id": ("cities", "city_id")},
          values={"customer_tier": TIERS}),
    Table("customer_addresses",
          "address_id:long! customer_id:long! address_label:str street_address:str area:str city_id:long "
          "latitude:dec9.6 longitude:dec9.6 is_default:bool!",
          "address_id", refs={"customer_id": ("customers", "customer_id"), "city_id": ("cities", "city_id")},
          values={"address_label": ADDRESS_LABELS}),
    Table("delivery_partners",
          "partner_id:long! partner_name:str! phone:str! email:str city_id:long! zone_id:long vehicle_type:str! "
          "is_active:bool! current_status:str! rating:dec3.2 total_deliveries:long! total_earnings:dec24.2! "
          "joining_date:date! bg_verification:bool!",
          "partner_id", unique=(("phone",),),
          refs={"city_id": ("cities", "city_id"), "zone_id": ("zones", "zone_id")},
          ranges={"rating": _RATING}, values={"vehicle_type": VEHICLES, "current_status": PARTNER_STATES}),
    Table("promotions",
          "promotion_id:long! promo_code:str! promo_name:str promo_type:str! discount_value:dec8.2! "
          "min_order_amount:dec8.2! max_discount:dec8.2 max_uses:long current_uses:long! start_date:date! "
          "end_date:date! is_active:bool! applicable_to:str",
          "promotion_id", unique=(("promo_code",),), ranges={"discount_value": _POSITIVE},
          values={"promo_type": PROMO_TYPES, "applicable_to": PROMO_AUDIENCES}),
    Table("orders",
          "order_id:long! customer_id:long! restaurant_id:long! address_id:long zone_id:long promotion_id:long "
          "order_timestamp:ts! confirmed_at:ts prepared_at:ts picked_up_at:ts delivered_at:ts cancelled_at:ts "
          "order_status:str! order_channel:str! subtotal_amount:dec10.2! discount_amount:dec8.2! "
          "delivery_fee:dec6.2! taxes:dec8.2! total_amount:dec10.2! platform_commission:dec8.2! "
          "payment_method:str is_refunded:bool! refund_amount:dec10.2 cancellation_reason:str "
          "special_instructions:str order_date:date",
          "order_id",
          refs={"customer_id": ("customers", "customer_id"), "restaurant_id": ("restaurants", "restaurant_id"),
                "address_id": ("customer_addresses", "address_id"), "zone_id": ("zones", "zone_id"),
                "promotion_id": ("promotions", "promotion_id")},
          values={"order_status": ORDER_STATUSES, "order_channel": CHANNELS, "payment_method": PAYMENT_METHODS}),
    Table("order_items",
          "order_item_id:long! order_id:long! item_id:long! quantity:int! unit_price:dec8.2! item_total:dec12.2 "
          "special_notes:str",
          "order_item_id", refs={"order_id": ("orders", "order_id"), "item_id": ("menu_items", "item_id")},
          ranges={"quantity": _POSITIVE, "unit_price": _POSITIVE}),
    Table("deliveries",
          "delivery_id:long! order_id:long! partner_id:long assigned_at:ts restaurant_reached_at:ts "
          "picked_up_at:ts delivered_at:ts expected_delivery_time:ts actual_time_mins:int expected_time_mins:int "
          "distance_km:dec6.2 delivery_fee:dec6.2 delivery_status:str! sla_breached:bool on_time:bool "
          "delivery_rating:short partner_earnings:dec6.2",
          "delivery_id",
          refs={"order_id": ("orders", "order_id"), "partner_id": ("delivery_partners", "partner_id")},
          ranges={"delivery_rating": _STARS}, values={"delivery_status": DELIVERY_STATUSES}),
    Table("payments",
          "payment_id:long! order_id:long! amount:dec10.2! payment_method:str! payment_status:str! "
          "transaction_id:str payment_timestamp:ts! refund_amount:dec10.2 refund_timestamp:ts gateway_response:str",
          "payment_id", unique=(("transaction_id",),), refs={"order_id": ("orders", "order_id")},
          ranges={"amount": _POSITIVE}, values={"payment_status": PAYMENT_STATUSES}),
    Table("reviews",
          "review_id:long! order_id:long! customer_id:long! restaurant_id:long! partner_id:long food_rating:short! "
          "delivery_rating:short overall_rating:short review_text:str created_at:ts! is_verified:bool! "
          "helpful_votes:int!",
          "review_id", unique=(("order_id", "customer_id"),),
          refs={"order_id": ("orders", "order_id"), "customer_id": ("customers", "customer_id"),
                "restaurant_id": ("restaurants", "restaurant_id"),
                "partner_id": ("delivery_partners", "partner_id")},
          ranges={"food_rating": _STARS, "delivery_rating": _STARS, "overall_rating": _STARS}),
    Table("support_tickets",
          "ticket_id:long! customer_id:long! order_id:long issue_type:str! issue_description:str status:str! "
          "priority:str! created_at:ts! resolved_at:ts resolution_notes:str agent_id:str sla_breached:bool!",
          "ticket_id", refs={"customer_id": ("customers", "customer_id"), "order_id": ("orders", "order_id")},
          values={"issue_type": ISSUES, "status": TICKET_STATUSES, "priority": PRIORITIES}),
    Table("order_status_history",
          "history_id:long! order_id:long! status:str! changed_at:ts! changed_by:str notes:str",
          "history_id", refs={"order_id": ("orders", "order_id")}),
)}

# Columns a loader derives when the source does not carry them.
DERIVED: dict[str, dict[str, Callable[[], Column]]] = {
    "orders": {"order_date": lambda: F.col("order_timestamp").cast("date")},
    "order_items": {"item_total": lambda: (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)")},
    "deliveries": {
        "sla_breached": lambda: F.col("actual_time_mins") > SLA_MINUTES,
        "on_time": lambda: F.col("actual_time_mins") <= F.col("expected_time_mins"),
    },
}


def tier_for(spent: Column) -> Column:
    """Loyalty tier from lifetime spend."""
    tier = F.when(spent >= TIER_FLOORS[0][1], TIER_FLOORS[0][0])
    for name, floor in TIER_FLOORS[1:]:
        tier = tier.when(spent >= floor, name)
    return tier.otherwise("Bronze")


def derive(df: DataFrame, table: str) -> DataFrame:
    """Add the derived columns of ``table`` where they are missing."""
    for name, make in DERIVED.get(table, {}).items():
        if name not in df.columns:
            df = df.withColumn(name, make())
    return df


class Marketplace:
    """Named tables. ``m.orders("order_id", "total_amount")`` reads just those columns.

    ``provider(table, columns, since, until, own_since)`` returns a DataFrame with at least the asked
    columns; a provider that has to join for a column joins only when it is asked for. For ``orders`` the
    bounds are exact. For the other facts they let a store skip whole months: ``since`` and ``until`` by the
    date of the row's order, ``own_since`` by the row's own date; rows outside may still come, so a caller
    joins with bounded orders or filters as well.
    """

    def __init__(self, spark: SparkSession, provider: Callable[..., DataFrame]):
        self.spark = spark
        self._provider = provider
        # Materialised views by name, with the day they were computed for (see plans.refresh).
        self.stored: dict[str, tuple[date, DataFrame]] = {}
        # The object behind a provider, where a caller may need its raw tables.
        self.source: object | None = None

    def detached(self) -> Marketplace:
        """The same tables without stored views."""
        return Marketplace(self.spark, self._provider)

    def table(self, name: str, *columns: str, since: date | None = None, until: date | None = None,
              own_since: date | None = None) -> DataFrame:
        wanted = list(columns) or TABLES[name].names
        df = self._provider(name, wanted, since, until, own_since)
        return df if df.columns == wanted else df.select(*wanted)

    def __getattr__(self, name: str) -> Callable[..., DataFrame]:
        if name not in TABLES:
            raise AttributeError(name)
        return lambda *columns, **bounds: self.table(name, *columns, **bounds)


def from_frames(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Marketplace:
    """A marketplace over given DataFrames, for example tables read from storage."""

    def provide(name: str, columns: Iterable[str], since: date | None, until: date | None,
                own_since: date | None) -> DataFrame:
        if name not in frames:
            return spark.createDataFrame([], TABLES[name].schema)
        df = frames[name]
        derived = DERIVED.get(name, {})
        missing = {f.name: F.lit(None).cast(f.dataType) for f in TABLES[name].schema
                   if f.name not in df.columns and f.name not in derived}
        df = derive(df.withColumns(missing) if missing else df, name)
        if name == "orders":
            return between_dates(df, since, until)
        if "order_month" in df.columns:
            df = between_months(df, since, until, "order_month")
        return between_months(df, own_since, None, "own_month") if "own_month" in df.columns else df

    return Marketplace(spark, provide)


#: Facts other than orders, with the date of a row's own that readers ask for.
FACTS = {"order_items": None, "deliveries": "delivered_at", "payments": "payment_timestamp", "reviews": "created_at",
         "support_tickets": "created_at", "order_status_history": "changed_at"}


def with_month(orders: DataFrame) -> DataFrame:
    """Add the partition column of stored orders."""
    return orders.withColumn("order_month", month_of(F.col("order_date")))
