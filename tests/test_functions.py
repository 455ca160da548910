from __future__ import annotations

import random
import re
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from plateflow.functions.bands import band
from plateflow.functions.dates import months_apart, seconds_between, shift_months, sunday_zero
from plateflow.functions.exact import growth, percent, ratio
from plateflow.functions.ordering import Want, add_orders, add_previous, asc, desc, rank_among, tile_of, top
from plateflow.functions.quantiles import histogram, percentiles, rounded
from plateflow.functions.skew import join_spread
from plateflow.functions import tiles
from plateflow.functions.text import search_index, search_names, write_name_index


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("num,den,places,expected", [
    (1, 8, 2, "0.13"), (-1, 8, 2, "-0.13"), (1, -8, 2, "-0.13"), (2, 3, 0, "1"), (5, 2, 0, "3"), (-5, 2, 0, "-3"),
    (0, 7, 1, "0.0"), (1, 0, 2, None), (None, 3, 2, None), (3, None, 2, None),
])
def test_ratio_rounds_half_away_from_zero(spark, num, den, places, expected):
    got = one(spark, ratio(F.lit(num).cast("long"), F.lit(den).cast("long"), places))
    assert (None if got is None else str(got)) == expected


def test_ratio_of_money_is_exact(spark):
    total = F.lit(Decimal("1005.00"))
    assert str(one(spark, ratio(total, F.lit(1000), 2, num_scale=2))) == "1.01"
    # 1e17 cents over 3 does not fit a double exactly.
    assert str(one(spark, ratio(F.lit(Decimal("1000000000000000.01")), F.lit(3), 2, num_scale=2))) == "333333333333333.34"


def test_published_formulas(spark):
    assert str(one(spark, percent(F.lit(320), F.lit(1000), 1))) == "32.0"
    assert str(one(spark, growth(F.lit(520000), F.lit(487000), 1))) == "6.8"
    assert str(one(spark, percent(F.lit(97400), F.lit(487000), 2))) == "20.00"
    assert str(one(spark, percent(F.lit(850), F.lit(10000), 2))) == "8.50"
    assert str(one(spark, percent(F.lit(48700), F.lit(487000), 2))) == "10.00"
    assert one(spark, F.lit(Decimal("97400")) - F.lit(Decimal("45000")) - F.lit(Decimal("12000"))) == 40400


def test_dates(spark):
    assert one(spark, sunday_zero(F.lit(date(2024, 3, 3)))) == 0
    assert one(spark, months_apart(F.lit(date(2024, 3, 1)), F.lit(date(2023, 11, 1)))) == 4
    assert shift_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    secs = seconds_between(F.expr("timestamp_ntz'2024-03-09 23:59:59.5'"), F.expr("timestamp_ntz'2024-03-10 00:00:01'"))
    assert one(spark, secs) == Decimal("1.5")


def test_bands(spark):
    names = ("low", "mid", "high")
    got = [one(spark, band(F.lit(v).cast("int"), (10, 20), names)) for v in (10, 11, 20, 21, None)]
    assert got == ["low", "mid", "mid", "high", "high"]


@pytest.mark.parametrize("rows,tiles", [(7, 5), (3, 5), (10, 5), (1, 4), (0, 3)])
def test_tiles_match_ntile(spark, rows, tiles):
    got = [r["t"] for r in spark.range(rows).select(
        tile_of(F.col("id") + 1, F.lit(rows).cast("long"), tiles).alias("t")).collect()]
    sizes = [rows // tiles + (i < rows % tiles) for i in range(tiles)]
    assert sorted(got) == [i + 1 for i, n in enumerate(sizes) for _ in range(n)]


def ranked(spark, order, partition):
    rng = random.Random(7)
    # A third of the rows share one value and one group; some values are NULL.
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 5}", 5 if i % 3 == 1 else rng.choice([None, *range(40)]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(8)
    want = Want(order, partition=partition, row_number="rn", rank="rk", dense_rank="dr", rows="n", tiles=("t", 7),
                running=("run", "v"))
    window = W.partitionBy(*partition)
    values = [key.sort() for key in order]
    peers, total = window.orderBy(*values), window.orderBy(*values, "id")
    plain = df.withColumns({
        "rn": F.row_number().over(total), "rk": F.rank().over(peers), "dr": F.dense_rank().over(peers),
        "n": F.count(F.lit(1)).over(window), "t": F.ntile(7).over(total),
        "run": F.sum("v").over(total.rowsBetween(W.unboundedPreceding, 0))})
    return [sorted(map(tuple, x.collect()), key=lambda r: r[0]) for x in (add_orders(df, ["id"], want), plain)]


@pytest.mark.parametrize("order", [(asc("v"),), (desc("v"),), (desc("v", nulls_last=True),), (asc("g"), desc("v"))])
@pytest.mark.parametrize("partition", [(), ("g",)])
def test_distributed_order_equals_one_window(spark, order, partition):
    wide, plain = ranked(spark, order, partition)
    assert wide == plain


def test_previous_row_across_tasks(spark):
    rng = random.Random(3)
    rows = [(i, 1 if i % 3 == 0 else rng.randrange(60), rng.choice("abc")) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k int, v string").repartition(8)
    lag = df.withColumn("p", F.lag("v").over(W.partitionBy("k").orderBy("id")))
    wide, plain = ({(r["id"], r["p"]) for r in x.collect()} for x in (add_previous(df, "k", (asc("id"),), "v", "p"), lag))
    assert wide == plain and len(wide) == 2000


def test_rank_among(spark):
    rows = [(i, (i * 7) % 50) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, v long")
    few = top(df, 9, desc("id"))
    got = {r["id"]: r["rk"] for r in rank_among(few, df, "v", "rk", 9).collect()}
    assert got == {i: 1 + sum(v > (i * 7) % 50 for _, v in rows) for i in range(391, 400)}


@pytest.mark.parametrize("width", [1, 10, 65536])
def test_percentiles_are_exact(spark, width):
    rng = random.Random(1)
    data = {"a": [rng.randrange(-500, 500) for _ in range(301)], "b": [7], "c": [5] * 50 + [9]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("a", None)], "k string, v int")
    out = {r["k"]: r for r in percentiles(df, ["k"], "v", [10, 50, 90, 99], width).collect()}
    for k, vs in data.items():
        for p in (10, 50, 90, 99):
            assert abs(out[k][f"p{p}"] / 100 - float(np.percentile(vs, p))) < 1e-9
    assert str(one(spark, rounded(F.lit(4550).cast("long"), 0))) == "46"


def test_histogram_covers_everything(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 2, 49, 50, 99, 100]], "v int")
    rows = {r["bin"]: r["rows"] for r in histogram(df, "v", 50).collect()}
    counts, _ = np.histogram([0, 1, 2, 49, 50, 99, 100], bins=50)
    assert rows == {i + 1: int(n) for i, n in enumerate(counts) if n}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_keeps_every_row(spark, how):
    fact = spark.createDataFrame([(i, 1 if i % 2 else i % 20) for i in range(1000)] + [(5000, None), (5001, 999)],
                                 "rid long, k long")
    keyed = spark.range(15).withColumnRenamed("id", "k").withColumn("name", F.concat(F.lit("n"), "k"))
    spread = join_spread(fact, keyed, "k", "rid", how=how, hot_rows=50)
    want = sorted(map(repr, fact.join(keyed, "k", how).select("rid", "k", "name").collect()))
    assert sorted(map(repr, spread.select("rid", "k", "name").collect())) == want
    # The same where the keyed side knows its counts.
    sized = keyed.join(fact.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", "left").fillna(1, ["n"])
    spread = join_spread(fact, sized, "k", "rid", how=how, hot_rows=50, count_column="n")
    assert sorted(map(repr, spread.select("rid", "k", "name").collect())) == want


def test_name_search(spark):
    df = spark.createDataFrame([("Biryani House",), ("Burger Point",), ("Biriyani Hut",), ("",)], "n string")
    hits = {r["n"] for r in search_names(df, "n", "biryani house").collect()}
    assert "Biryani House" in hits and "Burger Point" not in hits and "" not in hits


@pytest.mark.parametrize("few", [60_000, 0])
def test_tiles_equal_ntile(spark, few, monkeypatch):
    """Ties, nulls, dates, decimals, both directions, fewer rows than tiles; found by fetching or by counting alone."""
    monkeypatch.setattr(tiles, "FEW", few)
    rng = random.Random(4)
    for n in (0, 3, 400):
        rows = [(i * 7 - 50, rng.choice([None, 1, 1, 1, 2, rng.randrange(10**6)]), None if i % 9 == 0 else rng.randrange(20)) for i in range(n)]
        df = spark.createDataFrame(rows, "id long, a long, b int").withColumns(
            {"c": (F.col("a") / 100).cast("decimal(20,2)"), "d": F.date_add(F.lit(date(2000, 1, 1)), F.col("b"))})
        got = tiles.add_tiles(df, "id", tiles.Tiles(desc("c"), "t1", 5), tiles.Tiles(asc("b"), "t2", 4),
                              tiles.Tiles(asc("d", nulls_last=False), "t3", 7))
        want = got.withColumns({"w1": F.ntile(5).over(W.orderBy(F.col("c").desc_nulls_first(), "id")),
                                "w2": F.ntile(4).over(W.orderBy(F.col("b").asc_nulls_last(), "id")),
                                "w3": F.ntile(7).over(W.orderBy(F.col("d").asc_nulls_first(), "id"))})
        assert got.count() == n and want.filter("t1 <> w1 or t2 <> w2 or t3 <> w3").count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    with pytest.raises(TypeError):
        tiles.add_tiles(spark.range(3).withColumn("x", F.lit("a")), "id", tiles.Tiles(asc("x"), "t", 2))


def test_indexed_search_finds_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(2)
    parts = ["blue", "ring", "almond", "linen", "ghost", "lime", "blu", "rings", "x1"]
    names = [(" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))),) for _ in range(120)] + [("",), (None,), ("!!",)] * 2
    df = spark.createDataFrame(names, "item string")
    write_name_index(df, "item", str(tmp_path))
    queries = [(1, "blue rings"), (2, "almnd linnen"), (3, "zzz"), (4, ""), (5, None), (6, "lime")]
    got = search_index(spark, str(tmp_path), spark.createDataFrame(queries, "query_id int, query string"))
    want = set()
    for number, query in queries:
        if query:
            for r in search_names(df.filter("item is not null").distinct(), "item", query).collect():
                want.add((number, r["item"], r["similarity_pct"]))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 5
    nothing = search_index(spark, str(tmp_path), spark.createDataFrame([(1, "")], "query_id int, query string"))
    assert nothing.collect() == [] and nothing.columns == ["query_id", "name", "similarity_pct"]
    # The one name found is read from one folder.
    one = search_index(spark, str(tmp_path), spark.createDataFrame([(1, "x1 x1 x1")], "query_id int, query string"), 99)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() >= 1 and re.search(r"PartitionFilters: \[[^\]]*folder#\d+ (=|IN)", plan)
