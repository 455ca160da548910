"""Parquet storage of the marketplace."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plateflow.functions.dates import month_of
from plateflow.model import FACTS, TABLES, Marketplace, from_frames, with_month
from plateflow.session import files


def write_orders(orders: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Orders by month, sorted by time inside each file so that row-group statistics prune days.

    The rebalance hint sizes the files: a large month is split over several tasks and
    small months share one, whatever the volume.
    """
    (
        with_month(orders).hint("rebalance", "order_month")
        .sortWithinPartitions("order_month", "order_timestamp")
        .write.mode(mode).partitionBy("order_month").parquet(path)
    )


#: Rows of a folder of the second layout of orders, about; their number follows the volume.
CUSTOMER_ROWS = 2_000_000
FEWEST_FOLDERS, MOST_FOLDERS = 16, 4096
#: A customer's folder follows from these, in Spark and on the driver alike; numbers in any steps are spread.
PRIME, SPREAD = 1_000_003, 7919


def _hidden_number(spark: SparkSession, path: str, value: int | None = None) -> int | None:
    """A number kept beside data in a file that readers of the folder pass over; with a value, written."""
    fs, make = files(spark, path)
    target = make(f"{path}/_folders")
    if value is not None:
        out = fs.create(target, True)
        out.write(bytearray(str(value), "utf-8"))
        out.close()
        return value
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return int(text)


def write_customer_orders(orders: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Orders by a hash of the customer. Rows are dealt by ranges of (folder, customer, time), so of a folder's files
    each holds customers of its own, sorted, and a customer with very many orders is spread over several."""
    spark = orders.sparkSession
    folders = _hidden_number(spark, path) if mode == "append" else None
    if folders is None:
        folders = min(MOST_FOLDERS, max(FEWEST_FOLDERS, -(-orders.count() // CUSTOMER_ROWS)))
    keys = ["customer_bucket", "customer_id", "order_timestamp"]
    folded = F.pmod(F.col("customer_id").cast("long"), F.lit(PRIME)) * SPREAD % PRIME
    bucket = (folded % folders).cast("int")
    (
        orders.withColumn("customer_bucket", bucket).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .write.mode(mode).partitionBy("customer_bucket").parquet(path)
    )
    _hidden_number(spark, path, folders)


def order_history(spark: SparkSession, path: str, customer_id: int, *columns: str) -> DataFrame:
    """The orders of one customer: one folder of the store is listed, and in it the row groups that may hold them are read."""
    root = f"{path}/orders_by_customer"
    fields = [*TABLES["orders"].schema, T.StructField("customer_bucket", T.IntegerType())]
    bucket = customer_id % PRIME * SPREAD % PRIME % (_hidden_number(spark, root) or FEWEST_FOLDERS)
    fs, make = files(spark, root)
    folder = f"{root}/customer_bucket={bucket}"
    reader = spark.read.schema(T.StructType(fields)).option("basePath", root)
    rows = reader.parquet(folder) if fs.exists(make(folder)) else spark.createDataFrame([], T.StructType(fields))
    rows = rows.filter((F.col("customer_bucket") == bucket) & (F.col("customer_id") == F.lit(customer_id).cast("long")))
    return rows.select(*(columns or TABLES["orders"].names))


@dataclass(frozen=True)
class Stored:
    """Where a marketplace was read from."""

    path: str


def month_columns(name: str) -> list[str]:
    """The partition columns of a stored fact: the month of its order, and that of its own date if it has one."""
    if name == "orders":
        return ["order_month"]
    if name not in FACTS:
        return []
    return ["order_month", "own_month"] if FACTS[name] else ["order_month"]


def _with_months(market: Marketplace, name: str) -> DataFrame:
    df = market.table(name)
    if name == "orders":
        return with_month(df)
    months = market.orders("order_id", "order_date").select("order_id", month_of(F.col("order_date")).alias("order_month"))
    df = df.join(months, "order_id", "left")
    return df.withColumn("own_month", month_of(F.col(FACTS[name]))) if FACTS[name] else df


def write_fact(market: Marketplace, name: str, path: str) -> None:
    """A fact by months, sorted by its own date inside each file."""
    months, own = month_columns(name), FACTS[name]
    (
        _with_months(market, name).hint("rebalance", *months).sortWithinPartitions(*months, own or "order_id")
        .write.mode("overwrite").partitionBy(*months).parquet(path)
    )


def write_co_bucketed(market: Marketplace, path: str, buckets: int) -> None:
    """All facts by months and, inside them, in ``buckets`` by order_id, so that joins on it need no shuffle.

    For stores whose months are large: every month has that many files.
    """
    spark = market.spark
    for name in ("orders", *FACTS):
        table = f"plateflow_write_{uuid.uuid4().hex}"
        writer = _with_months(market, name).repartition(buckets, "order_id").write.mode("overwrite").partitionBy(
            *month_columns(name)).bucketBy(buckets, "order_id").sortBy("order_id")
        writer.option("path", f"{path}/{name}").saveAsTable(table)
        spark.sql(f"drop table {table}")  # the files stay
    _hidden_number(spark, f"{path}/orders", buckets)


def _open_bucketed(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    """A stored fact with its buckets, as a table of this session."""
    table = f"plateflow_{hashlib.sha256(path.encode()).hexdigest()[:16]}_{name}"
    if not spark.catalog.tableExists(table):
        months = month_columns(name)
        columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[name].schema] + [f"{m} date" for m in months])
        spark.sql(f"create table {table} ({columns}) using parquet partitioned by ({', '.join(months)}) "
                  f"clustered by (order_id) sorted by (order_id) into {buckets} buckets location '{path}/{name}'")
        spark.sql(f"alter table {table} recover partitions")
    return spark.table(table)


def write_store(market: Marketplace, path: str, tables: Iterable[str] | None = None, buckets: int = 0) -> None:
    """Write every table once, orders in two layouts; later reads see typed, columnar, pruned data.

    ``buckets`` also co-locates all facts by order (see ``write_co_bucketed``).
    """
    names = list(tables or TABLES)
    if buckets:
        write_co_bucketed(market, path, buckets)
    for name in names:
        if name == "orders":
            if not buckets:
                write_orders(market.table(name), f"{path}/orders")
            write_customer_orders(market.table(name), f"{path}/orders_by_customer")
        elif name in FACTS:
            if not buckets:
                write_fact(market, name, f"{path}/{name}")
        else:
            market.table(name).write.mode("overwrite").parquet(f"{path}/{name}")


def open_store(spark: SparkSession, path: str, tables: Iterable[str] | None = None) -> Marketplace:
    """A marketplace over stored tables; declared schemas spare a look into the files."""
    frames = {}
    buckets = _hidden_number(spark, f"{path}/orders")
    for name in tables or TABLES:
        if buckets and month_columns(name):
            frames[name] = _open_bucketed(spark, path, name, buckets)
            continue
        fields = [*TABLES[name].schema, *[T.StructField(m, T.DateType()) for m in month_columns(name)]]
        frames[name] = spark.read.schema(T.StructType(fields)).parquet(f"{path}/{name}")
    market = from_frames(spark, frames)
    market.source = Stored(path)
    return market
