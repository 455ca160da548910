"""Streaming twins of the running totals, each next to its batch form.

Figures that are read often are kept in ledgers (``ledger.py``) and the audit log in chains
(``chain.py``): a micro-batch touches the buckets its keys fall into, and reading opens no event.
The plain event store below keeps the events themselves, one folder for each micro-batch, for
whoever asks another question later: a batch that is run again after a failure replaces what it
wrote, repeats are removed by the events' keys on reading, and ``compact`` bounds the number of
files. In both, neither replays nor files that arrive late or in another order change a figure,
and nothing is dropped for its age.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plateflow.functions.exact import ratio
from plateflow.functions.ordering import add_previous, asc
from plateflow.model import Marketplace, tier_for
from plateflow.session import delete, shared_dir
from plateflow.streaming.ledger import Ledger

DELAY = "10 minutes"


def workspace(spark: SparkSession) -> str:
    """A fresh folder on shared storage for one stream's files and checkpoint."""
    return f"{shared_dir(spark)}/plateflow-{uuid.uuid4().hex}"


@contextmanager
def passing_workspace(spark: SparkSession) -> Iterator[str]:
    """A workspace that is deleted when the block ends; ``cut`` what is to outlive it."""
    base = workspace(spark)
    try:
        yield base
    finally:
        delete(spark, base)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New Parquet files as a stream: those of a folder, or the one at ``path``; ``max_files`` bounds a micro-batch."""
    # A pattern may name a folder or a file; a plain path must be a folder.
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(pattern)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what is there and stop; the same query with another trigger runs for ever."""
    query = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


# ---- event store ---------------------------------------------------------------------

def keep_events(events: DataFrame, path: str, checkpoint: str, *keys: str) -> None:
    """Write the events of each micro-batch under its number, each key once."""
    spark = events.sparkSession
    # A store without events can be read as well.
    spark.createDataFrame([], events.schema).write.mode("ignore").parquet(f"{path}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        _one_per_key(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_available(events, write, checkpoint)


def _one_per_key(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key: that with the smallest other columns, whatever the order of arrival."""
    rest = [c for c in events.columns if c not in keys]
    one = events.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest"))
    return one.select(*[F.col(c) if c in keys else F.col(f"_rest.{c}").alias(c) for c in events.columns])


def read_events(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The events kept so far, each key once."""
    return _one_per_key(spark.read.parquet(path).drop("batch"), keys)


def compact(spark: SparkSession, path: str, target: str, *keys: str) -> None:
    """The events so far as one batch of a new store."""
    read_events(spark, path, *keys).write.mode("overwrite").parquet(f"{target}/batch=-1")


# ---- totals of customers, restaurants, partners, promotions -------------------------

def deliveries_of(changes: DataFrame, key: str, amount: str) -> DataFrame:
    """Changes to Delivered; a change feed has (order_id, status, changed_at, ...). The first one of an order counts."""
    return changes.filter(F.col("status") == "Delivered").select("order_id", "changed_at", key, amount)


def stream_totals(changes: DataFrame, key: str, amount: str, path: str, checkpoint: str) -> None:
    """Keep the delivered orders (or trips) that ``totals`` sums."""
    keep_events(deliveries_of(changes, key, amount), path, checkpoint, "order_id")


def totals(events: DataFrame, key: str, amount: str) -> DataFrame:
    """Count, sum and last time of delivered orders (or trips) per ``key``."""
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(amount, F.lit(0))).cast("decimal(24,2)").alias("total"),
        F.max("changed_at").cast("timestamp_ntz").alias("last"))


def batch_totals(changes: DataFrame, key: str, amount: str) -> DataFrame:
    """The same from a full feed."""
    return totals(_one_per_key(deliveries_of(changes, key, amount), ["order_id"]), key, amount)


def _shape(*columns: tuple[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns)


def totals_ledger(key: str, amount: str) -> Ledger:
    """Delivered orders (or trips): count, sum and last time per ``key``; the first delivery of an order counts."""
    return Ledger(_shape(("order_id", "long"), ("changed_at", "timestamp_ntz"), (key, "long"), (amount, "decimal(10,2)")),
                  ("order_id",), key, {"total": amount}, latest="changed_at")


def fold_totals(changes: DataFrame, key: str, amount: str, path: str, checkpoint: str) -> None:
    """Take a change feed into a ledger of totals."""
    fold = totals_ledger(key, amount).consumer(path)
    run_available(deliveries_of(changes, key, amount), fold, checkpoint)


def ledger_totals(spark: SparkSession, key: str, amount: str, path: str) -> DataFrame:
    """What ``totals`` gives, from a ledger's figures."""
    return totals_ledger(key, amount).figures(spark, path).select(
        key, "n", F.col("total").cast("decimal(24,2)").alias("total"), F.col("latest").alias("last"))


def customer_totals(sums: DataFrame) -> DataFrame:
    return sums.select("customer_id", F.col("n").alias("total_orders"), F.col("total").alias("total_spent"),
                       F.col("last").alias("last_order_date"), tier_for(F.col("total")).alias("customer_tier"))


def restaurant_totals(sums: DataFrame) -> DataFrame:
    return sums.select("restaurant_id", F.col("n").alias("total_orders"), F.col("total").alias("total_revenue"))


def partner_totals(sums: DataFrame) -> DataFrame:
    return sums.select("partner_id", F.col("n").alias("total_deliveries"), F.col("total").alias("total_earnings"))


def placed_with_promotion(changes: DataFrame) -> DataFrame:
    return changes.filter((F.col("status") == "Placed") & F.col("promotion_id").isNotNull()).select(
        "order_id", "changed_at", "promotion_id")


def stream_promotion_usage(changes: DataFrame, path: str, checkpoint: str) -> None:
    """Keep the placed orders with a promotion."""
    keep_events(placed_with_promotion(changes), path, checkpoint, "order_id")


USES = Ledger("order_id long, changed_at timestamp_ntz, promotion_id long", ("order_id",), "promotion_id")


def fold_promotion_usage(changes: DataFrame, path: str, checkpoint: str) -> None:
    run_available(placed_with_promotion(changes), USES.consumer(path), checkpoint)


def promotion_usage(uses: DataFrame, promotions: DataFrame) -> DataFrame:
    """Promotions with their uses; used-up ones are closed."""
    return with_usage(promotions, uses.groupBy("promotion_id").agg(F.count(F.lit(1)).alias("n")))


def with_usage(promotions: DataFrame, counted: DataFrame) -> DataFrame:
    """Promotions with the counts (promotion_id, n) of their uses; used-up ones are closed."""
    counted = counted.withColumnRenamed("n", "_n")
    n = F.coalesce("_n", F.lit(0)).cast("long")
    open_ = F.col("is_active") & (F.col("max_uses").isNull() | (n < F.col("max_uses")))
    return promotions.join(counted, "promotion_id", "left").select(
        "promotion_id", "promo_code", n.alias("current_uses"), open_.alias("is_active"))


def batch_promotion_usage(changes: DataFrame, promotions: DataFrame) -> DataFrame:
    return promotion_usage(_one_per_key(placed_with_promotion(changes), ["order_id"]), promotions)


# ---- ratings -------------------------------------------------------------------------

def stream_ratings(feed: DataFrame, key: str, path: str, checkpoint: str) -> None:
    """Keep the versions of every entry of a feed (entry_id, version, rating, ...)."""
    keep_events(feed.select("entry_id", "version", key, "rating"), path, checkpoint, "entry_id", "version")


def ratings(feed: DataFrame, key: str) -> DataFrame:
    """Ratings per ``key``, from the last version of every entry; one that moved to another key left its first."""
    last = feed.groupBy("entry_id").agg(F.max(F.struct("version", key, "rating")).alias("_v")).select("_v.*")
    return last.filter(F.col(key).isNotNull()).groupBy(key).agg(
        ratio(F.sum("rating"), F.count("rating"), 2).alias("rating"), F.count(F.lit(1)).alias("total_ratings"))


def ratings_ledger(key: str) -> Ledger:
    """Ratings per ``key``: an entry's old rating goes out as its new one comes in."""
    return Ledger(_shape(("entry_id", "long"), ("version", "int"), (key, "long"), ("rating", "int")), ("entry_id",), key,
                  {"stars": "rating", "rated": "if(rating is null, 0, 1)"}, newest=("version",))


def fold_ratings(feed: DataFrame, key: str, path: str, checkpoint: str) -> None:
    run_available(feed.select("entry_id", "version", key, "rating"), ratings_ledger(key).consumer(path), checkpoint)


def ledger_ratings(spark: SparkSession, key: str, path: str) -> DataFrame:
    """What ``ratings`` gives, from a ledger's figures."""
    return ratings_ledger(key).figures(spark, path).select(
        key, ratio(F.col("stars"), F.col("rated"), 2).alias("rating"), F.col("n").alias("total_ratings"))


# ---- audit log -----------------------------------------------------------------------

def stream_status(events: DataFrame, path: str, checkpoint: str) -> None:
    """Keep the status events (event_id, order_id, status, changed_at) from which log and monitor follow."""
    keep_events(events.select("event_id", "order_id", "status", "changed_at"), path, checkpoint, "event_id")


def audit_log(events: DataFrame) -> DataFrame:
    """A row for the first status of an order and for every real change."""
    rows = add_previous(events, "order_id", (asc("changed_at"), asc("event_id")), "status", "from_status")
    return rows.filter(~F.col("status").eqNullSafe(F.col("from_status"))).select(
        "order_id", "from_status", "status", "changed_at")


def first_status(log: DataFrame) -> DataFrame:
    """The entry each order starts its log with."""
    return log.filter("from_status is null").select("order_id", "status", "changed_at")


# ---- live monitor and demand windows -------------------------------------------------

def live_monitor(events: DataFrame) -> DataFrame:
    """Orders by status, from the newest event of each order, with the open ones marked."""
    rows = events.groupBy("order_id").agg(F.max_by("status", F.struct("changed_at", "event_id")).alias("status"))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("orders")).withColumn(
        "is_open", ~F.col("status").isin("Delivered", "Cancelled"))


#: The newest status of every order, counted by status.
NEWEST = Ledger("order_id long, changed_at timestamp, event_id long, status string", ("order_id",), "status",
                newest=("changed_at", "event_id"))


def fold_monitor(events: DataFrame, path: str, checkpoint: str) -> None:
    run_available(events.select(*NEWEST.entry.names), NEWEST.consumer(path), checkpoint)


def ledger_monitor(spark: SparkSession, path: str) -> DataFrame:
    """What ``live_monitor`` gives, from a ledger's figures: one row for each status is read."""
    return NEWEST.figures(spark, path).select(
        "status", F.col("n").alias("orders"), (~F.col("status").isin("Delivered", "Cancelled")).alias("is_open"))


def unassigned_orders(m: Marketplace) -> DataFrame:
    """Open orders without a delivery per zone, the longest waiting first."""
    from plateflow.operators.requests import waiting_orders

    return waiting_orders(m).groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("unassigned"), F.min("order_timestamp").alias("waiting_since")).orderBy("waiting_since")


def stream_demand(events: DataFrame, path: str, checkpoint: str) -> None:
    """Keep the events (event_id, changed_at, cents) that ``demand_windows`` counts."""
    keep_events(events.select("event_id", "changed_at", "cents"), path, checkpoint, "event_id")


def demand_windows(events: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Events and amounts per (sliding) window."""
    window = F.window("changed_at", width, slide) if slide else F.window("changed_at", width)
    return events.groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("cents").alias("cents")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "events", "cents")


def closing_windows(events: DataFrame, width: str = "1 hour", slide: str | None = None, delay: str = DELAY) -> DataFrame:
    """``demand_windows`` with ``is_closed``: the newest event is ``delay`` or more past the window's end.

    An event that comes after its window was closed still counts when the store is read again.
    """
    newest = events.agg(F.max("changed_at").alias("_newest")).select(
        (F.col("_newest").cast("timestamp_ntz") - F.expr(f"interval {delay}")).alias("_until"))
    return demand_windows(events, width, slide).withColumn("is_closed", F.col("window_end") <= newest.scalar())


@dataclass(frozen=True)
class Demand:
    """Demand in partial windows of ``slide``; a window of ``times`` slides adds up as many partials on reading."""

    slide: str = "1 hour"
    times: int = 1
    delay: str = DELAY

    @property
    def ledger(self) -> Ledger:
        return Ledger("event_id long, changed_at timestamp, start timestamp, cents long, late int", ("event_id",), "start",
                      {"cents": "cents", "late": "late"}, latest="changed_at")

    def fold(self, events: DataFrame, path: str, checkpoint: str) -> None:
        """Take events (event_id, changed_at, cents); those that come after their partial was closed count and are marked late."""
        spark = events.sparkSession

        def each(batch: DataFrame, number: int) -> None:
            newest = self.ledger.figures(spark, path).agg(F.max("latest").alias("_newest"))
            window = F.window("changed_at", self.slide)
            closed = newest.select(F.col("_newest") - F.expr(f"interval {self.delay}")).scalar()
            rows = batch.select("event_id", "changed_at", window["start"].alias("start"), "cents",
                                F.coalesce((window["end"] <= closed).cast("int"), F.lit(0)).alias("late"))
            self.ledger.fold(rows, number, path)

        run_available(events.select("event_id", "changed_at", "cents"), each, checkpoint)

    def windows(self, spark: SparkSession, path: str) -> DataFrame:
        """window_start, window_end, events, cents, is_closed and late (events that came after their partial was closed)."""
        partials = self.ledger.figures(spark, path)
        step = F.expr(f"interval {self.slide}")
        starts = F.transform(F.sequence(F.lit(0), F.lit(self.times - 1)), lambda i: F.col("start") - step * i)
        spread = partials.select(F.explode(starts).alias("window_start"), "n", "cents", "late")
        newest = partials.agg((F.max("latest").cast("timestamp_ntz") - F.expr(f"interval {self.delay}")).alias("_until"))
        end = (F.col("window_start") + step * F.lit(self.times)).cast("timestamp_ntz")
        return spread.groupBy("window_start").agg(
            F.sum("n").alias("events"), F.sum("cents").alias("cents"), F.sum("late").alias("late")).select(
            F.col("window_start").cast("timestamp_ntz").alias("window_start"), end.alias("window_end"), "events", "cents",
            "late").withColumn("is_closed", F.col("window_end") <= newest.scalar())
