"""Joining a fact table to a keyed table when single keys hold a large share of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from plateflow.functions.literal import table_of

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 1_000_000
# Keys are counted in so many groups first.
GROUPS = 1 << 14


def hot_keys(fact: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key, n`` of the keys with more than ``hot_rows`` facts, for ``join_spread``.

    Rows are counted by a hash of the key, and by key only where a hash has enough of them, so
    hardly anything is shuffled. ``fact`` is read twice at most: store it before. The list has at
    most ``facts / hot_rows`` entries and is held by the driver.
    """
    found = fact.filter(F.col(key).isNotNull()).select(key, F.pmod(F.xxhash64(key), F.lit(GROUPS)).alias("_group"))
    n = F.count(F.lit(1)).alias("n")
    full = [r["_group"] for r in found.groupBy("_group").agg(n).filter(F.col("n") > hot_rows).collect()]
    rows = found.filter(F.col("_group").isin(full)).groupBy(key).agg(n).filter(F.col("n") > hot_rows).collect() if full else []
    return table_of(fact.sparkSession, [tuple(r) for r in rows],
                    T.StructType([T.StructField(key, fact.schema[key].dataType), T.StructField("n", T.LongType())]))


def join_spread(fact: DataFrame, keyed: DataFrame, key: str, row_id: str, how: str = "inner",
                hot_rows: int = HOT_ROWS, counts: DataFrame | None = None, count_column: str | None = None) -> DataFrame:
    """``fact`` joined to ``keyed`` (unique on ``key``) with hot keys salted.

    Only keys above ``hot_rows`` are copied, one copy per ``hot_rows`` facts, so the
    copies add at most one row per ``hot_rows`` facts. The list of hot keys has at most
    ``facts / hot_rows`` entries; whether it is broadcast is left to its size.
    ``counts`` (key, n) saves the counting pass where the caller already has it; so does
    ``count_column``, where ``keyed`` itself holds the number of facts per key.
    """
    if count_column is not None:
        counts = keyed.select(key, F.col(count_column).alias("n"))
    elif counts is None:
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.filter((F.col("n") > hot_rows) & F.col(key).isNotNull()).select(
        key, F.expr(f"cast(n div {hot_rows} + 1 as int)").alias("_copies")
    )
    salted = fact.join(hot, key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(row_id), F.col("_copies")), F.lit(0)).cast("int")
    ).drop("_copies")
    if count_column is not None:
        sized = keyed.withColumn("_copies", F.expr(f"cast({count_column} div {hot_rows} + 1 as int)"))
    else:
        sized = keyed.join(hot, key, "left")
    copied = (
        sized.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
        .drop("_copies")
    )
    return salted.join(copied, [key, "_salt"], how).drop("_salt")
