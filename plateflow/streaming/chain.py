"""The audit log as kept state: events of each order chained in event-time order.

Events are dealt to buckets by order and kept once each. A micro-batch re-chains only its own
orders, and of these only what lies at or after their first new event: the log's rows from there on
are taken back and written again, so an event that comes late changes the one row after it. The
part of an order that is chained anew is numbered by ranges of (order, time, event), so an order
with a large share of all events is spread over tasks. Reading opens the log alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plateflow.functions.ordering import add_previous, asc
from plateflow.streaming.state import MOST_FILES, Manifest, Store, bucket_of

EVENTS = "order_id long, event_id long, changed_at timestamp, status string"
LOG = f"{EVENTS}, from_status string"
BUCKETS = 16


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


def _place() -> Column:
    """Where an event lies in the chain of its order."""
    return F.struct("changed_at", "event_id")


def _once(events: DataFrame) -> DataFrame:
    """Each event of an order once: that with the smallest other columns."""
    one = events.groupBy("order_id", "event_id").agg(F.min(F.struct("changed_at", "status")).alias("_e"))
    return one.select("order_id", "event_id", "_e.*")


def fold(batch: DataFrame, number: int, path: str, buckets: int = BUCKETS) -> None:
    """Take a micro-batch of status events (event_id, order_id, status, changed_at) into the log at ``path``.

    A number that was committed is passed over; events that were there before change nothing.
    """
    spark = batch.sparkSession
    store = Store(spark, path, buckets)
    state = store.manifest()
    if number <= state.number:
        return
    after = state.following(number)
    came = _once(batch.select(*[F.col(f.name).cast(f.dataType) for f in _schema(EVENTS)])).withColumn("bucket", bucket_of(["order_id"], buckets)).persist()
    try:
        touched = {r[0] for r in came.select("bucket").distinct().collect()}  # one number per bucket
        if touched:
            known = store.read("events", _schema(EVENTS), state.parts("events", touched))
            a, b = came.alias("a"), known.alias("b")
            same = F.col("a.order_id").eqNullSafe(F.col("b.order_id")) & F.col("a.event_id").eqNullSafe(F.col("b.event_id"))
            store.write("events", number, a.join(b, same, "left_anti"))
            fresh = store.written("events", number)
            for bucket in fresh:
                after.replace("events", bucket, [*state.tables.get("events", {}).get(bucket, []), number])
            if fresh:
                _rechain(store, state, after, set(fresh))
    finally:
        came.unpersist()
    store.commit(after)


def _rechain(store: Store, state: Manifest, after: Manifest, fresh: set[int]) -> None:
    number = after.number
    new = store.read("events", _schema(EVENTS), [(number, b) for b in sorted(fresh)])
    since = new.groupBy("order_id").agg(F.min(_place()).alias("_since"))
    old = store.read("events", _schema(EVENTS), state.parts("events", fresh))
    mine = old.alias("o").join(since.alias("s"), F.col("o.order_id").eqNullSafe(F.col("s.order_id"))).select("o.*", "_since")
    later = mine.filter(_place() >= F.col("_since")).drop("_since")
    before = mine.filter(_place() < F.col("_since")).groupBy("order_id", "bucket").agg(
        F.max_by(F.struct("event_id", "changed_at", "status"), _place()).alias("_e")).select("order_id", "bucket", "_e.*")
    rows = later.unionByName(new).withColumn("_known", F.lit(False)).unionByName(before.withColumn("_known", F.lit(True)))
    chained = add_previous(rows, "order_id", (asc("changed_at"), asc("event_id")), "status", "from_status")
    again = chained.filter(~F.col("_known") & ~F.col("status").eqNullSafe(F.col("from_status"))).drop("_known")
    log = store.read("log", _schema(LOG), state.parts("log", fresh))
    stays = log.alias("l").join(since.alias("s"), F.col("l.order_id").eqNullSafe(F.col("s.order_id")), "left").filter(
        F.col("_since").isNull() | (_place() < F.col("_since"))).select("l.*")
    store.write("log", number, stays.unionByName(again.select(*stays.columns)))
    held = set(store.written("log", number))
    for bucket in fresh:
        after.replace("log", bucket, [number] if bucket in held else [])
    for bucket in sorted(b for b, batches in after.tables["events"].items() if len(batches) > MOST_FILES):
        whole = store.read("events", _schema(EVENTS), after.parts("events", {bucket})).drop("bucket")
        whole.write.mode("overwrite").parquet(f"{store.path}/events/batch={-number - 2}/bucket={bucket}")
        after.replace("events", bucket, [-number - 2])


def read_log(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """order_id, from_status, status, changed_at: the first status of an order and every real change."""
    store = Store(spark, path, buckets)
    rows = store.read("log", _schema(LOG), store.manifest().parts("log"))
    return rows.select("order_id", "from_status", "status", "changed_at")
