"""Constraints of the model as a validation job.

Every table is scanned once for all its row-local rules; keys and references are one
aggregation and one join for all tables together. A rule yields a count, never the offending rows, unless
they are asked for with :func:`rejects`.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plateflow.functions.literal import table_of
from plateflow.functions.ordering import add_previous, asc
from plateflow.functions.skew import join_spread
from plateflow.model import DELIVERY_MOVES, ORDER_MOVES, TABLES, Marketplace


def row_rules(table: str, as_of: date) -> dict[str, Column]:
    """Row-local rules of a table: name -> condition under which a row fails (NULL passes)."""
    spec = TABLES[table]
    rules: dict[str, Column] = {}
    for f in spec.schema:
        if not f.nullable:
            rules[f"D4 {f.name} not null"] = F.col(f.name).isNull()
    for column, (low, high, open_) in spec.ranges.items():
        value, bad = F.col(column), F.lit(False)
        if low is not None:
            bad = bad | ((value <= low) if open_ else (value < low))
        if high is not None:
            bad = bad | (value > high)
        rules[f"D5 {column} in range"] = bad
    for column, values in spec.values.items():
        rules[f"D6 {column} known"] = ~F.col(column).isin(*values)
    c = F.col
    if table == "promotions":
        rules["D7 end after start"] = c("end_date") <= c("start_date")
    if table == "deliveries":
        rules["D7 delivery time positive"] = c("actual_time_mins") <= 0
    if table == "orders":
        rules["D7 discount within subtotal"] = c("discount_amount") > c("subtotal_amount")
        rules["D8 total adds up"] = c("total_amount") != (
            c("subtotal_amount") - c("discount_amount") + c("delivery_fee") + c("taxes"))
        rules["D9 total not negative"] = c("total_amount") < 0
        rules["D10 not in the future"] = c("order_timestamp") > F.lit(
            datetime(as_of.year, as_of.month, as_of.day)).cast("timestamp_ntz") + F.expr("interval 1 day")
    return rules


# Rules over a share of some rows only: name -> (table, rows considered, failing, allowed share).
def rate_rules() -> dict[str, tuple[str, Column, Column, str]]:
    cancelled = F.col("order_status") == "Cancelled"
    return {"D9 cancellation has a reason": (
        "orders", cancelled, cancelled & F.col("cancellation_reason").isNull(), "0.005")}


def _fails(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _one(rows: DataFrame, rule: str, table: str) -> DataFrame:
    """Name a one-row (n_rows, n_failed) result."""
    return rows.select(F.lit(rule).alias("rule_id"), F.lit(table).alias("table_name"), "n_rows",
                       F.coalesce("n_failed", F.lit(0)).cast("long").alias("n_failed"),
                       F.lit(Decimal("0")).cast("decimal(10,6)").alias("max_rate"))


def check_rows(m: Marketplace, table: str, as_of: date) -> DataFrame:
    """All row-local rules of a table in one scan."""
    rules = row_rules(table, as_of)
    rates = {k: v for k, v in rate_rules().items() if v[0] == table}
    names = list(rules) + list(rates)
    aggregates = [_fails(rules[n]).alias(f"f{i}") for i, n in enumerate(rules)]
    aggregates += [_fails(rates[n][2]).alias(f"f{len(rules) + i}") for i, n in enumerate(rates)]
    considered = {n: f"s{i}" for i, n in enumerate(rates)}
    aggregates += [_fails(rates[n][1]).alias(alias) for n, alias in considered.items()]
    one = m.table(table).agg(F.count(F.lit(1)).alias("n"), *aggregates)
    items = [F.struct(
        F.lit(name).alias("rule_id"), F.col(considered.get(name, "n")).alias("n_rows"),
        F.col(f"f{i}").alias("n_failed"),
        F.lit(Decimal(rates[name][3] if name in rates else "0")).cast("decimal(10,6)").alias("max_rate"))
        for i, name in enumerate(names)]
    return one.select(F.explode(F.array(*items)).alias("r")).select(
        "r.rule_id", F.lit(table).alias("table_name"), "r.n_rows", "r.n_failed", "r.max_rate")


def _keys_of(table: str) -> dict[str, list[str]]:
    spec = TABLES[table]
    rules = {"D1 primary key": [spec.key]}
    rules |= {f"D2 unique {', '.join(k)}": list(k) for k in spec.unique}
    return rules


def _expected(m: Marketplace, names: list[tuple[str, str]]) -> DataFrame:
    """The list of rules, so that a rule without rows still reports."""
    return table_of(m.spark, names, T.StructType.fromDDL("rule_id string, table_name string"))


def _completed(m: Marketplace, names: list[tuple[str, str]], counted: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return _expected(m, names).join(counted, ["rule_id", "table_name"], "left").select(
        "rule_id", "table_name", F.coalesce("n_rows", zero).alias("n_rows"),
        F.coalesce("n_failed", zero).alias("n_failed"), F.lit(Decimal("0")).cast("decimal(10,6)").alias("max_rate"))


def check_keys(m: Marketplace, tables: Iterable[str]) -> DataFrame:
    """Surplus rows per key. A table is scanned once for all its keys; NULL keys are not compared."""
    parts, names = [], []
    for table in tables:
        rules = _keys_of(table)
        names += [(rule, table) for rule in rules]
        columns = dict.fromkeys(c for keys in rules.values() for c in keys)
        entries = F.array(*[F.struct(
            F.lit(rule).alias("rule_id"),
            # concat is NULL as soon as one part is.
            F.concat_ws("|", F.array(*[F.col(k).cast("string") for k in keys])).alias("key"),
            F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull().alias("full"))
            for rule, keys in rules.items()])
        parts.append(m.table(table, *columns).select(F.lit(table).alias("table_name"), F.explode(entries).alias("e"))
                     .filter("e.full").select("table_name", "e.rule_id", "e.key"))
    groups = _union(parts).groupBy("rule_id", "table_name", "key").agg(F.count(F.lit(1)).alias("_n"))
    return _completed(m, names, groups.groupBy("rule_id", "table_name").agg(
        F.sum("_n").alias("n_rows"), F.sum(F.col("_n") - 1).alias("n_failed")))


def check_references(m: Marketplace, tables: Iterable[str]) -> DataFrame:
    """Rows whose reference has no target.

    Each table is read once for all its references and each target once for its keys.
    References are counted per value first, so a value that a third of the rows carry
    meets its target as one row.
    """
    parts, names, targets = [], [], {}
    for table in tables:
        refs = TABLES[table].refs
        if not refs:
            continue
        names += [(f"D3 {c} references {t}", table) for c, (t, _) in refs.items()]
        targets |= {t: key for t, key in refs.values()}
        entries = F.array(*[F.struct(
            F.lit(f"D3 {c} references {t}").alias("rule_id"), F.lit(t).alias("target"), F.col(c).alias("value"))
            for c, (t, _) in refs.items()])
        parts.append(m.table(table, *refs).select(F.lit(table).alias("table_name"), F.explode(entries).alias("e"))
                     .select("table_name", "e.*").filter("value is not null"))
    if not parts:
        raise ValueError("no table with references given")
    used = _union(parts).groupBy("rule_id", "table_name", "target", "value").agg(F.count(F.lit(1)).alias("_n"))
    known = _union(m.table(t, key).select(F.lit(t).alias("target"), F.col(key).alias("value"))
                   for t, key in targets.items()).distinct().withColumn("_known", F.lit(True))
    return _completed(m, names, used.join(known, ["target", "value"], "left").groupBy("rule_id", "table_name").agg(
        F.sum("_n").alias("n_rows"), F.sum(F.when(F.col("_known").isNull(), F.col("_n"))).alias("n_failed")))


def payment_matches_order(m: Marketplace) -> DataFrame:
    pays = m.payments("order_id", "amount").join(m.orders("order_id", "total_amount"), "order_id")
    off = F.abs(F.col("amount") - F.col("total_amount")) > F.lit(Decimal("0.01"))
    return _one(pays.agg(F.count(F.lit(1)).alias("n_rows"), _fails(off).alias("n_failed")),
                "D10 payment matches order", "payments")


def _moves(m: Marketplace, moves: dict[str, tuple[str, ...]]) -> DataFrame:
    pairs = [(a, b) for a, targets in moves.items() for b in targets]
    return F.broadcast(table_of(m.spark, pairs, T.StructType.fromDDL("_from string, status string")))


def transitions(m: Marketplace) -> DataFrame:
    """Status changes of each order with the status before."""
    steps = m.order_status_history("history_id", "order_id", "status", "changed_at")
    return add_previous(steps, "order_id", (asc("changed_at"), asc("history_id")), "status", "_from").filter(
        "_from is not null")


def illegal_transitions(m: Marketplace, as_of: date | None = None) -> DataFrame:
    """Counts of status changes that the order states do not allow."""
    return transitions(m).join(_moves(m, ORDER_MOVES), ["_from", "status"], "left_anti").groupBy(
        F.col("_from").alias("from_status"), F.col("status").alias("to_status")).agg(
        F.count(F.lit(1)).alias("changes"))


def legal_transitions(m: Marketplace) -> DataFrame:
    steps = transitions(m)
    legal = _moves(m, ORDER_MOVES).withColumn("_ok", F.lit(True))
    rows = steps.join(legal, ["_from", "status"], "left").agg(
        F.count(F.lit(1)).alias("n_rows"), _fails(F.col("_ok").isNull()).alias("n_failed"))
    return _one(rows, "D11 legal status change", "order_status_history")


def legal_delivery_changes(m: Marketplace, history: DataFrame) -> DataFrame:
    """The same for delivery states; ``history`` is (delivery_id, status, changed_at)."""
    steps = add_previous(history, "delivery_id", (asc("changed_at"),), "status", "_from").filter("_from is not null")
    legal = _moves(m, DELIVERY_MOVES).withColumn("_ok", F.lit(True))
    rows = steps.join(legal, ["_from", "status"], "left").agg(
        F.count(F.lit(1)).alias("n_rows"), _fails(F.col("_ok").isNull()).alias("n_failed"))
    return _one(rows, "D11 legal delivery change", "deliveries")


def delivery_history(m: Marketplace) -> DataFrame:
    """Delivery states implied by the stored times and final status."""
    c = F.col
    ended = F.coalesce(c("delivered_at"), c("picked_up_at"), c("assigned_at"))
    marks = [("Assigned", c("assigned_at")), ("En Route to Restaurant", c("restaurant_reached_at")),
             ("Picked Up", c("picked_up_at"))]
    entries = F.array(*[F.struct(F.lit(s).alias("status"), at.alias("changed_at")) for s, at in marks],
                      F.struct(c("delivery_status").alias("status"), ended.alias("changed_at")))
    trips = m.deliveries("delivery_id", "assigned_at", "restaurant_reached_at", "picked_up_at", "delivered_at",
                         "delivery_status")
    kept = F.filter(entries, lambda e: e["changed_at"].isNotNull())
    return trips.select("delivery_id", F.explode(kept).alias("e")).select("delivery_id", "e.status", "e.changed_at")


def reviews_of_delivered(m: Marketplace) -> DataFrame:
    ok = m.orders("order_id", "order_status").filter(F.col("order_status") == "Delivered").select(
        "order_id", F.lit(True).alias("_ok"))
    rows = m.reviews("order_id").join(ok, "order_id", "left").agg(
        F.count(F.lit(1)).alias("n_rows"), _fails(F.col("_ok").isNull()).alias("n_failed"))
    return _one(rows, "D12 review of a delivered order", "reviews")


def minimum_amounts(m: Marketplace) -> DataFrame:
    """Orders below the minimum of their restaurant or promotion.

    Orders of a busy restaurant are spread over several tasks to meet its minimum.
    """
    orders = m.orders("order_id", "restaurant_id", "subtotal_amount")
    low = F.col("subtotal_amount") < F.col("min_order_amount")
    rest = join_spread(orders, m.restaurants("restaurant_id", "min_order_amount"), "restaurant_id", "order_id").agg(
        F.count(F.lit(1)).alias("n_rows"), _fails(low).alias("n_failed"))
    promo = m.orders("promotion_id", "subtotal_amount").filter("promotion_id is not null").join(
        m.promotions("promotion_id", "min_order_amount"), "promotion_id").agg(
        F.count(F.lit(1)).alias("n_rows"), _fails(low).alias("n_failed"))
    return _one(rest, "D13 restaurant minimum", "orders").unionByName(_one(promo, "D13 promotion minimum", "orders"))


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df)
    return out


def judged(checks: DataFrame) -> DataFrame:
    """Add the failure rate and the verdict."""
    rate = F.when(F.col("n_rows") > 0, F.round(
        F.col("n_failed").cast("decimal(20,0)") / F.col("n_rows").cast("decimal(20,0)"), 6)).otherwise(F.lit(0))
    ok = F.col("n_failed").cast("decimal(38,6)") <= F.col("n_rows").cast("decimal(20,0)") * F.col("max_rate")
    return checks.select("rule_id", "table_name", "n_rows", "n_failed", rate.cast("decimal(12,6)").alias("rate"),
                         "max_rate", ok.alias("passed"))


def validate_rows(m: Marketplace, as_of: date, tables: Iterable[str] | None = None) -> DataFrame:
    return judged(_union(check_rows(m, t, as_of) for t in tables or TABLES))


def validate_keys(m: Marketplace, as_of: date | None = None, tables: Iterable[str] | None = None) -> DataFrame:
    return judged(check_keys(m, tables or TABLES))


def validate_references(m: Marketplace, as_of: date | None = None, tables: Iterable[str] | None = None) -> DataFrame:
    return judged(check_references(m, tables or TABLES))


def validate_business(m: Marketplace, as_of: date | None = None) -> DataFrame:
    return judged(_union((payment_matches_order(m), legal_transitions(m),
                          legal_delivery_changes(m, delivery_history(m)), reviews_of_delivered(m),
                          minimum_amounts(m))))


def validate(m: Marketplace, as_of: date) -> DataFrame:
    """Every rule: identifier, rows looked at, failures, rate, allowed rate, verdict."""
    return _union((validate_rows(m, as_of), validate_keys(m), validate_references(m), validate_business(m)))


def rejects(m: Marketplace, table: str, rule_id: str, as_of: date) -> DataFrame:
    """The rows of ``table`` that break a row-local rule."""
    rules = row_rules(table, as_of) | {k: v[2] for k, v in rate_rules().items() if v[0] == table}
    return m.table(table).filter(F.coalesce(rules[rule_id], F.lit(False)))
