"""Exact continuous percentiles of an integer column, without gathering a group.

The values are first counted per (group, value); the counts are then located in two
steps, a coarse bucket and the value inside it, so no window spans more than the
number of coarse buckets or ``width`` values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plateflow.functions.exact import attach, ratio


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def percentiles(df: DataFrame, keys: Sequence[str], value: str, points: Sequence[int], width: int = 65536,
                weight: str | None = None) -> DataFrame:
    """One row per group: ``n`` and ``total`` of the values, and per point ``p<point>``, the percentile
    times 100 as an exact integer.

    ``keys`` must not be NULL; NULL values are ignored. ``weight``: a column that says how often the
    value counts. Use :func:`rounded` on the result.
    """
    keys = list(keys)
    counts = (
        df.filter(F.col(value).isNotNull())
        .select(*keys, F.col(value).cast("long").alias("_v"), (F.col(weight) if weight else F.lit(1)).alias("_w"))
        .groupBy(*keys, "_v")
        .agg(F.sum("_w").alias("_c"))
        .withColumn("_b", F.floor(F.col("_v") / F.lit(width)).cast("long"))
    )
    weighted = F.col("_v").cast("decimal(20,0)") * F.col("_c").cast("decimal(18,0)")
    coarse = counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_c"), F.sum(weighted).alias("_s"))
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    coarse = coarse.select(
        *keys,
        "_b",
        F.sum("_c").over(group).alias("_n"),
        F.sum("_s").over(group).cast("decimal(38,0)").alias("_total"),
        F.sum("_c").over(group.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)).alias("_upto"),
        "_c",
    )
    wanted = []
    for point in points:
        low = _div((F.col("_n") - 1) * F.lit(point), F.lit(100))
        wanted.append(F.struct(F.lit(point).alias("p"), F.lit(0).alias("side"), low.alias("at")))
        high = F.least(low + 1, F.col("_n") - 1)
        wanted.append(F.struct(F.lit(point).alias("p"), F.lit(1).alias("side"), high.alias("at")))
    start = F.col("_upto") - F.col("_c")
    inside = F.filter(F.array(*wanted), lambda t: (t["at"] >= start) & (t["at"] < F.col("_upto")))
    hits = coarse.select(*keys, "_b", "_n", "_total", F.transform(
        inside, lambda t: F.struct(t["p"].alias("p"), t["side"].alias("side"), (t["at"] - start).alias("at"))
    ).alias("_t")).filter(F.size("_t") > 0)

    fine = counts.join(hits, [*keys, "_b"])
    cell = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    fine = fine.withColumn("_upto", F.sum("_c").over(cell))
    begin = F.col("_upto") - F.col("_c")
    found = fine.select(
        *keys, "_v", "_n", "_total",
        F.explode(F.filter("_t", lambda t: (t["at"] >= begin) & (t["at"] < F.col("_upto")))).alias("_t"),
    )
    picks: list[Column] = [F.max("_n").alias("_n"), F.max("_total").alias("_total")]
    for point in points:
        for side in (0, 1):
            at = (F.col("_t.p") == point) & (F.col("_t.side") == side)
            picks.append(F.max(F.when(at, F.col("_v"))).alias(f"_{point}_{side}"))
    grouped = found.groupBy(*keys).agg(*picks) if keys else found.agg(*picks)
    out = []
    for point in points:
        rest = ((F.col("_n") - 1) * F.lit(point)) % F.lit(100)
        out.append((F.col(f"_{point}_0") * (F.lit(100) - rest) + F.col(f"_{point}_1") * rest).alias(f"p{point}"))
    return grouped.select(*keys, F.col("_n").alias("n"), F.col("_total").alias("total"), *out)


def rounded(scaled: Column, places: int, scale: int = 0, unit: int = 1) -> Column:
    """Turn a ``p<point>`` column into a decimal; ``scale`` digits of the values are after the point."""
    return ratio(scaled, F.lit(100 * 10**scale * unit).cast("decimal(38,0)"), places)


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed on both sides."""
    keys = list(keys)
    present = df.filter(F.col(value).isNotNull())
    bounds = (present.groupBy(*keys) if keys else present).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    placed = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    placed = placed.join(bounds, keys) if keys else attach(placed, bounds)
    index = _div(
        ((F.col(value) - F.col("_lo")) * F.lit(bins)).cast("decimal(38,4)"),
        F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1)).cast("decimal(38,4)"),
    )
    return (
        placed.withColumn("bin", (F.least(index, F.lit(bins - 1)) + 1).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.sum("_c").alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"))
    )
