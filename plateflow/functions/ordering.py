"""Global rankings that never gather the table in one task.

``row_number``, ``rank`` or ``ntile`` over the whole table (or over a partition that may hold a
third of it) would run in a single task as a plain window. The frame is range-partitioned on
(partition, order, id) instead: every task numbers its own rows, and a summary of one row per task
and partition key supplies the offsets. Frames of any size go the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plateflow.session import cut


@dataclass(frozen=True)
class By:
    """A sort key. NULLs come last when ascending and first when descending unless told otherwise."""

    column: str
    descending: bool = False
    nulls_last: bool | None = None

    def sort(self) -> Column:
        value = F.col(self.column)
        last = (not self.descending) if self.nulls_last is None else self.nulls_last
        if self.descending:
            return value.desc_nulls_last() if last else value.desc_nulls_first()
        return value.asc_nulls_last() if last else value.asc_nulls_first()


def asc(column: str, nulls_last: bool | None = None) -> By:
    return By(column, False, nulls_last)


def desc(column: str, nulls_last: bool | None = None) -> By:
    return By(column, True, nulls_last)


def ordered(*keys: By | Callable[[], Column]):
    """Let an operator return its rows in this order, after the last join. A key that is no column of the result is
    given as a function that makes the sort expression. Whoever aggregates or joins the result on pays no sort."""

    def wrap(operator):
        @wraps(operator)
        def run(*args, **parameters) -> DataFrame:
            return operator(*args, **parameters).orderBy(*[k.sort() if isinstance(k, By) else k() for k in keys])

        return run

    return wrap


def top(df: DataFrame, k: int | None, *keys: By) -> DataFrame:
    """The first ``k`` rows of a total order (a per-task heap, not a global sort)."""
    ordered = df.orderBy(*[key.sort() for key in keys])
    return ordered if k is None else ordered.limit(k)


def tile_of(number: Column, rows: Column, tiles: int) -> Column:
    """``ntile`` from a row number: larger tiles first."""
    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    size = div(rows, F.lit(tiles))
    extra = rows % F.lit(tiles)
    in_large = div(number - 1, size + 1) + 1
    in_small = extra + div(number - 1 - extra * (size + 1), F.greatest(size, F.lit(1))) + 1
    return F.when(number <= extra * (size + 1), in_large).otherwise(in_small).cast("int")


@dataclass(frozen=True)
class Want:
    """Columns to add to a frame under one ordering; a name turns the column on."""

    order: Sequence[By]
    partition: Sequence[str] = ()
    row_number: str | None = None
    rank: str | None = None
    dense_rank: str | None = None
    rows: str | None = None
    tiles: tuple[str, int] | None = None
    running: tuple[str, str] | None = None  # (new column, summed column)


def add_orders(df: DataFrame, ids: Sequence[str], *wants: Want) -> DataFrame:
    """Add ranking columns. ``ids`` make every order total, so results are repeatable.

    Each ordering is one range shuffle, written once to the shared folder.
    """
    for want in wants:
        df = _distributed(df, ids, want)
    return df


def _distributed(df: DataFrame, ids: Sequence[str], want: Want) -> DataFrame:
    parts = list(want.partition)
    keys = [F.col(p).asc_nulls_first() for p in parts]
    keys += [key.sort() for key in want.order] + [F.col(i).asc() for i in ids]
    original = df.columns
    # The id below encodes (task, position); the checkpoint freezes both.
    placed = cut(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    )
    rows = placed.select(
        *original,
        F.shiftright("_at", 33).alias("_task"),
        F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )
    value = F.struct(*[F.col(key.column) for key in want.order])
    block = W.partitionBy("_task", *parts)
    ranked = bool(want.rank or want.dense_rank)
    if ranked:
        rows = rows.withColumn(
            "_run", F.min("_pos").over(W.partitionBy("_task", *parts, *[k.column for k in want.order]))
        )
    if want.dense_rank:
        rows = rows.withColumn("_dense", F.dense_rank().over(block.orderBy(*[k.sort() for k in want.order])))
    if want.running:
        rows = rows.withColumn(
            "_sum", F.sum(want.running[1]).over(block.orderBy("_pos").rowsBetween(W.unboundedPreceding, 0))
        )

    # One row per (task, partition key).
    measures = [F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_lo")]
    if ranked:
        measures += [
            F.min_by(value, "_pos").alias("_head"),
            F.max_by(value, "_pos").alias("_tail"),
            F.max_by("_run", "_pos").alias("_tail_run"),
        ]
    if want.dense_rank:
        measures.append(F.max("_dense").alias("_runs"))
    if want.running:
        measures.append(F.sum(want.running[1]).alias("_part_sum"))
    blocks = rows.groupBy("_task", *parts).agg(*measures)
    along = W.partitionBy(*parts) if parts else W.partitionBy(F.lit(0))
    before = along.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    blocks = blocks.withColumn("_all", F.sum("_n").over(along))
    if want.running:
        blocks = blocks.withColumn("_sum_before", F.sum("_part_sum").over(before))
    if ranked:
        blocks = blocks.withColumn("_tail_at", F.col("_before") + F.col("_tail_run") - F.col("_lo") + 1)
        first = blocks.groupBy(*parts, "_tail").agg(
            F.min("_tail_at").alias("_start"), F.min("_task").alias("_start_task")
        )
        mine, theirs = blocks.alias("b"), first.alias("f")
        on = F.col("b._head").eqNullSafe(F.col("f._tail")) & (F.col("f._start_task") < F.col("b._task"))
        for p in parts:
            on &= F.col(f"b.{p}").eqNullSafe(F.col(f"f.{p}"))
        blocks = mine.join(theirs, on, "left").select("b.*", "f._start")
    if want.dense_rank:
        step = along.orderBy("_task")
        continues = F.when(F.col("_head").eqNullSafe(F.lag("_tail").over(step)) & (F.col("_before") > 0), 1).otherwise(0)
        blocks = blocks.withColumn("_cont", continues)
        upto = step.rowsBetween(W.unboundedPreceding, 0)
        blocks = blocks.withColumn(
            "_dense_before",
            F.coalesce(F.sum("_runs").over(before), F.lit(0)) - F.sum("_cont").over(upto),
        )

    keep = [c for c in ("_lo", "_before", "_all", "_start", "_dense_before", "_sum_before") if c in blocks.columns]
    blocks = blocks.select("_task", *parts, *keep)
    left, right = rows.alias("r"), blocks.alias("s")
    on = F.col("r._task") == F.col("s._task")
    for p in parts:
        on &= F.col(f"r.{p}").eqNullSafe(F.col(f"s.{p}"))
    joined = left.join(right, on).select("r.*", *[f"s.{c}" for c in keep])

    number = F.col("_before") + F.col("_pos") - F.col("_lo") + 1
    added: dict[str, Column] = {}
    if want.row_number:
        added[want.row_number] = number
    if want.rank:
        head = F.col("_run") == F.col("_lo")
        added[want.rank] = F.when(head, F.coalesce("_start", F.col("_before") + 1)).otherwise(
            F.col("_before") + F.col("_run") - F.col("_lo") + 1
        )
    if want.dense_rank:
        added[want.dense_rank] = F.col("_dense") + F.col("_dense_before")
    if want.rows:
        added[want.rows] = F.col("_all")
    if want.tiles:
        added[want.tiles[0]] = tile_of(number, F.col("_all"), want.tiles[1])
    if want.running:
        total = F.col("_sum") + F.coalesce(F.col("_sum_before"), F.lit(0))
        added[want.running[0]] = F.when(F.col("_sum").isNull(), F.col("_sum_before")).otherwise(total)
    return joined.select(*original, *[c.alias(n) for n, c in added.items()])


def add_previous(df: DataFrame, key: str, order: Sequence[By], value: str, name: str) -> DataFrame:
    """``value`` of the row before within ``key``, also where one key holds much of the table.

    The frame is range-partitioned on (key, order): a task looks back inside its own rows, and its
    first row takes the last one of the task before.
    """
    keys = [F.col(key).asc_nulls_first(), *[k.sort() for k in order]]
    placed = cut(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_task", F.shiftright("_at", 33))
    entry = F.struct(F.col(key).alias("k"), F.col(value).alias("v"))
    ends = placed.groupBy("_task").agg(F.max_by(entry, "_at").alias("_end"))
    # One row per shuffle task; empty tasks have no row and are skipped.
    carried = ends.select("_task", F.lag("_end").over(W.partitionBy(F.lit(0)).orderBy("_task")).alias("_carried"))
    inside = F.lag(entry).over(W.partitionBy("_task").orderBy("_at"))
    rows = placed.withColumn("_inside", inside).join(carried, "_task")
    before = F.coalesce("_inside", "_carried")
    return rows.withColumn(name, F.when(before["k"].eqNullSafe(F.col(key)), before["v"])).drop(
        "_at", "_task", "_inside", "_carried")


def rank_among(few: DataFrame, every: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """Descending rank of the at most ``k`` rows of ``few`` among all rows of ``every``.

    One pass over ``every`` counts the rows between the few values, in at most ``k`` + 1 groups;
    nothing is sorted or moved.
    """
    if k < 1:
        return few.withColumn(name, F.lit(None).cast("long"))
    marks = few.agg(F.array_sort(F.collect_set(value)).alias("_marks")).scalar()
    marked = every.select(value, marks.alias("_marks"))
    below = marked.select(F.size(F.filter("_marks", lambda m: m < F.col(value))).alias("_b"))
    counts = below.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.agg(F.collect_list(F.struct("_b", "_n")).alias("_c")).scalar()
    ahead = F.filter("_c", lambda c: c["_b"] >= F.array_position("_marks", F.col(value)))
    return few.withColumns({"_marks": marks, "_c": counts}).withColumn(
        name, F.aggregate(ahead, F.lit(1).cast("long"), lambda total, c: total + c["_n"])).drop("_marks", "_c")
