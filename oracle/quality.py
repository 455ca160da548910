"""Validation rules."""

from __future__ import annotations


def rows(parts: list[tuple[str, str, str, str, str]]) -> str:
    """(rule, table, rows, failed, allowed rate) queries."""
    return " UNION ALL ".join(
        f"SELECT '{r}' AS rule_id, '{t}' AS table_name, ({n})::BIGINT AS n_rows, coalesce(({f}),0)::BIGINT AS n_failed, {x}::DOUBLE AS max_rate"
        for r, t, n, f, x in parts)


def judged(body: str) -> str:
    return f""", checks AS ({body}) SELECT rule_id, table_name, n_rows, n_failed, CASE WHEN n_rows>0 THEN round(n_failed*1000000.0/n_rows)/1000000 ELSE 0 END::DOUBLE AS rate,
 max_rate, n_failed<=n_rows*max_rate AS passed FROM checks"""


def unique(table: str, rel: str, keys: str, rule: str) -> tuple[str, str, str, str, str]:
    return (rule, table, f"SELECT count(*) FROM {rel} WHERE ({keys}) IS NOT NULL",
            f"SELECT count(*)-count(DISTINCT ({keys})) FROM {rel} WHERE ({keys}) IS NOT NULL", "0")


def ref(table: str, rel: str, col: str, name: str, target: str, trel: str, tcol: str) -> tuple[str, str, str, str, str]:
    return (f"D3 {name} references {target}", table, f"SELECT count({col}) FROM {rel}",
            f"SELECT count(*) FROM {rel} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {tcol} FROM {trel})", "0")


CATS = "(SELECT s_suppkey*10+unnest([1,2]) AS category_id, s_suppkey AS rid FROM supplier)"
PHONE = "D2 unique phone"
KEYS = [
    unique("cities", "city", "city_id", "D1 primary key"), unique("zones", "zn", "zone_id", "D1 primary key"),
    unique("restaurants", "rest", "rid", "D1 primary key"), unique("restaurants", "rest", "'k'||rid", "D2 unique email"),
    unique("menu_categories", CATS, "category_id", "D1 primary key"), unique("menu_items", "item", "item_id", "D1 primary key"),
    unique("customers", "cust", "cid", "D1 primary key"), unique("customers", "cust", "email", "D2 unique email"),
    unique("customers", "cust", "'+91'||cid", PHONE), unique("customer_addresses", "customer", "c_custkey", "D1 primary key"),
    unique("delivery_partners", "prt", "partner_id", "D1 primary key"), unique("delivery_partners", "prt", "'+91'||partner_id", PHONE),
    unique("promotions", "promo", "promotion_id", "D1 primary key"), unique("promotions", "promo", "promo_code", "D2 unique promo_code"),
    unique("orders", "ord", "oid", "D1 primary key"), unique("order_items", "oi", "order_item_id", "D1 primary key"),
    unique("deliveries", "dl", "oid", "D1 primary key"), unique("payments", "pay", "oid", "D1 primary key"),
    unique("payments", "pay", "transaction_id", "D2 unique transaction_id"), unique("reviews", "rv", "oid", "D1 primary key"),
    ("D2 unique order_id, customer_id", "reviews", "SELECT count(*) FROM rv", "SELECT count(*)-count(DISTINCT oid||'-'||cid) FROM rv", "0"),
    unique("support_tickets", "tk", "ticket_id", "D1 primary key"), unique("order_status_history", "hist", "oid*10+i", "D1 primary key"),
]
C, R, Z, U, O, P = (("cities", "city", "city_id"), ("restaurants", "rest", "rid"), ("zones", "zn", "zone_id"),
                    ("customers", "cust", "cid"), ("orders", "ord", "oid"), ("delivery_partners", "prt", "partner_id"))
REFS = [
    ref("zones", "zn", "city_id", "city_id", *C), ref("restaurants", "rest", "city_id", "city_id", *C), ref("restaurants", "rest", "zone_id", "zone_id", *Z),
    ref("menu_categories", CATS, "rid", "restaurant_id", *R), ref("menu_items", "item", "rid", "restaurant_id", *R),
    ref("menu_items", "item", "category_id", "category_id", "menu_categories", CATS, "category_id"), ref("customers", "cust", "city_id", "city_id", *C),
    ref("customer_addresses", "customer", "c_custkey", "customer_id", *U), ref("customer_addresses", "customer", "c_nationkey", "city_id", *C),
    ref("delivery_partners", "prt", "city_id", "city_id", *C), ref("delivery_partners", "prt", "zone_id", "zone_id", *Z),
    ref("orders", "ord", "cid", "customer_id", *U), ref("orders", "ord", "rid", "restaurant_id", *R), ref("orders", "ord", "cid", "address_id", "customer_addresses", "customer", "c_custkey"),
    ref("orders", "ord", "zid", "zone_id", *Z), ref("orders", "ord", "pid", "promotion_id", "promotions", "promo", "promotion_id"),
    ref("order_items", "oi", "oid", "order_id", *O), ref("order_items", "oi", "item_id", "item_id", "menu_items", "item", "item_id"),
    ref("deliveries", "dl", "oid", "order_id", *O), ref("deliveries", "dl", "partner_id", "partner_id", *P), ref("payments", "pay", "oid", "order_id", *O),
    ref("reviews", "rv", "oid", "order_id", *O), ref("reviews", "rv", "cid", "customer_id", *U), ref("reviews", "rv", "rid", "restaurant_id", *R), ref("reviews", "rv", "partner_id", "partner_id", *P),
    ref("support_tickets", "tk", "cid", "customer_id", *U), ref("support_tickets", "tk", "oid", "order_id", *O), ref("order_status_history", "hist", "oid", "order_id", *O),
]
LEGAL = """('Placed','Confirmed'),('Placed','Cancelled'),('Confirmed','Preparing'),('Confirmed','Cancelled'),('Preparing','Ready'),('Preparing','Cancelled'),('Ready','Picked Up'),('Picked Up','On The Way'),('On The Way','Delivered')"""
STEPS = f""", st AS (SELECT lag(status) OVER (PARTITION BY oid ORDER BY changed_at, i) AS a, status AS b FROM hist), ok(a, b) AS (VALUES {LEGAL})"""
BUSINESS = [
    ("D10 payment matches order", "payments", "SELECT count(*) FROM pay", "SELECT count(*) FROM pay JOIN ord USING (oid) WHERE abs(amount_c-total_c)>1", "0"),
    ("D11 legal status change", "order_status_history", "SELECT count(*) FROM st WHERE a IS NOT NULL", "SELECT count(*) FROM st WHERE a IS NOT NULL AND (a, b) NOT IN (SELECT (a, b) FROM ok)", "0"),
    # Assigned, Picked Up and the end of each trip: both steps skip a state.
    ("D11 legal delivery change", "deliveries", "SELECT count(*)*2 FROM dl", "SELECT count(*)*2 FROM dl", "0"),
    ("D12 review of a delivered order", "reviews", "SELECT count(*) FROM rv", "SELECT count(*) FROM rv WHERE oid NOT IN (SELECT oid FROM ord WHERE dlv)", "0"),
    ("D13 restaurant minimum", "orders", "SELECT count(*) FROM ord", "SELECT count(*) FROM ord WHERE sub_c<14900", "0"),
    ("D13 promotion minimum", "orders", "SELECT count(pid) FROM ord", "SELECT count(*) FROM ord JOIN promo ON pid=promotion_id WHERE sub_c<least_c", "0"),
]

SQL = {
    "d1_d2_keys": judged(rows(KEYS)),
    "d3_references": judged(rows(REFS)),
    "d10_d13_business_rules": STEPS + judged(rows(BUSINESS)),
    "d11_illegal_transitions": STEPS + " SELECT a AS from_status, b AS to_status, count(*) AS changes FROM st WHERE a IS NOT NULL AND (a, b) NOT IN (SELECT (a, b) FROM ok) GROUP BY 1, 2",
}


def _row_rules() -> str:
    """Expected verdicts of the row-local rules: everything holds but what the star is known to break."""
    from plateflow.model import TABLES

    rel = {"cities": "city", "zones": "zn", "restaurants": "rest", "menu_categories": CATS, "menu_items": "item", "customers": "cust",
           "customer_addresses": "customer", "delivery_partners": "prt", "promotions": "promo", "orders": "ord", "order_items": "oi",
           "deliveries": "dl", "payments": "pay", "reviews": "rv", "support_tickets": "tk", "order_status_history": "hist"}
    known = {
        ("restaurants", "D5 rating in range"): "rating_c NOT BETWEEN 0 AND 500", ("restaurants", "D5 commission_rate in range"): "rate NOT BETWEEN 5 AND 40",
        ("menu_items", "D5 price in range"): "price_c<=0", ("order_items", "D5 quantity in range"): "quantity<=0", ("payments", "D5 amount in range"): "amount_c<=0",
        ("reviews", "D5 food_rating in range"): "food NOT BETWEEN 1 AND 5", ("orders", "D7 discount within subtotal"): "disc_c>sub_c",
        ("orders", "D8 total adds up"): "total_c<>sub_c-disc_c+fee_c+tax_c", ("orders", "D9 total not negative"): "total_c<0",
        ("orders", "D10 not in the future"): "ts>TIMESTAMP '2001-08-03'", ("deliveries", "D7 delivery time positive"): "mins<=0",
        ("promotions", "D7 end after start"): "end_date<=start_date",
        ("orders", "D6 order_status known"): "st NOT IN ('Delivered','Cancelled','On The Way')",
    }
    parts = []
    for name, spec in TABLES.items():
        rules = [f"D4 {f.name} not null" for f in spec.schema if not f.nullable]
        rules += [f"D5 {c} in range" for c in spec.ranges] + [f"D6 {c} known" for c in spec.values]
        rules += [r for t, r in known if t == name and r not in rules]
        for r in rules:
            cond = known.get((name, r), "false")
            parts.append((r, name, f"SELECT count(*) FROM {rel[name]}", f"SELECT count(*) FROM {rel[name]} WHERE {cond}", "0"))
    parts.append(("D9 cancellation has a reason", "orders", "SELECT count(*) FROM ord WHERE can", "SELECT count(*) FROM ord WHERE can AND reason IS NULL", "0.005"))
    return judged(rows(parts))


SQL["d4_d9_row_rules"] = _row_rules()
