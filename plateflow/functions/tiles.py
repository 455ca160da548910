"""Equal groups of a whole table (``ntile``) without ordering it.

The tile of a row follows from where the last row of every tile lies in the order of (value, id). Those
few places are found by counting: the values between smallest and largest are counted in equal steps,
the step that holds a place is counted in finer ones, and where many rows share the value, their ids
are counted in the same way. Once few rows are left they are looked at one by one. Rows are compared
with the places found; they are never sorted or moved.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plateflow.functions.ordering import By

#: Counters of one pass, shared by all places looked for; and rows that are fetched in the end.
COUNTERS, FEW = 1 << 15, 60_000


@dataclass(frozen=True)
class Tiles:
    """``name``: the tile (from 1) among ``tiles`` equal groups, larger ones first, in the order ``by``."""

    by: By
    name: str
    tiles: int


@dataclass(frozen=True)
class _Search:
    """The ``need``-th row (from 1) among those whose value and id lie in these closed bounds."""

    want: int
    low: int
    high: int
    id_low: int
    id_high: int
    need: int

    @property
    def area(self) -> tuple[int, int, int, int, int]:
        return self.want, self.low, self.high, self.id_low, self.id_high

    @property
    def found(self) -> bool:
        return self.low == self.high and self.id_low == self.id_high


def _whole(df: DataFrame, by: By) -> Column:
    """The value as a whole number, smaller ones first."""
    value, kind = F.col(by.column), df.schema[by.column].dataType
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif isinstance(kind, T.DecimalType):
        value = (value.cast(f"decimal(38,{kind.scale})") * F.lit(10**kind.scale)).cast("decimal(38,0)")
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"tiles need whole numbers, decimals or dates, not {kind.simpleString()}")
    value = value.cast("long")
    return -value if by.descending else value


def _nulls_last(by: By) -> bool:
    return (not by.descending) if by.nulls_last is None else by.nulls_last


def add_tiles(df: DataFrame, row_id: str, *wants: Tiles) -> DataFrame:
    """``df`` with an int column per want. ``row_id`` (a whole number, not null) decides between equal values.

    ``df`` is computed once for the search (its values and ids are kept meanwhile) and once for the
    result. At most ``COUNTERS`` counters or ``FEW`` rows come to the driver at a time. Rows equal
    in value and id share a tile; an empty table stays empty.
    """
    names = [f"k{i}" for i in range(len(wants))]
    keys = df.select(*[_whole(df, w.by).alias(n) for n, w in zip(names, wants, strict=True)],
                     F.col(row_id).cast("long").alias("id")).persist()
    try:
        bounds = keys.agg(F.count(F.lit(1)), F.min("id"), F.max("id"), *[f(n) for n in names for f in (F.min, F.max)]).first()
        rows, id_low, id_high = bounds[:3]
        low = {i: bounds[3 + 2 * i] for i in range(len(wants)) if bounds[3 + 2 * i] is not None}
        high = {i: bounds[4 + 2 * i] for i in low}
        # A null lies one beyond the last value or one before the first.
        null = {i: ((high.get(i, 0) + 1) if _nulls_last(w.by) else (low.get(i, 0) - 1)) for i, w in enumerate(wants)}
        placed = [F.coalesce(F.col(n), F.lit(null[i])) for i, n in enumerate(names)]
        searches = {}
        for i, want in enumerate(wants):
            for tile in range(1, want.tiles):
                last = (rows // want.tiles) * tile + min(tile, rows % want.tiles)
                if 0 < last < rows:
                    searches[i, tile] = _Search(i, min(low.get(i, null[i]), null[i]), max(high.get(i, null[i]), null[i]),
                                                id_low, id_high, last)
        _search(keys, placed, searches, rows)
    finally:
        keys.unpersist()
    out = {}
    for i, want in enumerate(wants):
        value = F.coalesce(_whole(df, want.by), F.lit(null[i]))
        ids, tile = F.col(row_id).cast("long"), F.lit(1)
        for tile_no in range(1, want.tiles):
            place = searches.get((i, tile_no))  # a tile that reaches the last row ends nowhere before it
            if place is not None:
                beyond = (value > place.low) | ((value == place.low) & (ids > place.id_low))
                tile = tile + beyond.cast("int")
        out[want.name] = tile.cast("int")
    return df.withColumns(out)


def _search(keys: DataFrame, placed: Sequence[Column], searches: dict, rows: int) -> None:
    """Narrow every search until it has found its row."""
    size = {s.area: rows for s in searches.values()}
    while any(not s.found for s in searches.values()):
        areas = sorted({s.area for s in searches.values() if not s.found})
        if sum(size[a] for a in areas) <= FEW:
            _fetch(keys, placed, searches, areas)
            return
        steps = max(16, COUNTERS // len(areas))
        codes = []
        for number, area in enumerate(areas):
            by, start, width = _axis(area, steps)
            value = placed[area[0]] if by else F.col("id")
            # Subtract in decimals: bounds may lie farther apart than a long reaches.
            step = F.call_function("div", value.cast("decimal(20,0)") - F.lit(start).cast("decimal(20,0)"),
                                   F.lit(width).cast("decimal(20,0)"))
            codes.append(F.when(_inside(area, placed), step + F.lit(number * steps).cast("long")))
        counted = keys.select(F.explode(F.array_compact(F.array(*codes))).alias("code")).groupBy("code").agg(
            F.count(F.lit(1)).alias("n"))
        counts: dict[int, Counter] = {n: Counter() for n in range(len(areas))}
        for code, n in counted.collect():
            counts[code // steps][code % steps] = n
        for key, search in list(searches.items()):
            if search.found:
                continue
            area = search.area
            by, start, width = _axis(area, steps)
            need = search.need
            for step in sorted(counts[areas.index(area)]):
                n = counts[areas.index(area)][step]
                if need <= n:
                    break
                need -= n
            first = start + step * width
            last = min(first + width - 1, search.high if by else search.id_high)
            found = replace(search, low=first, high=last, need=need) if by else replace(
                search, id_low=first, id_high=last, need=need)
            searches[key] = found
            size[found.area] = n


def _axis(area: tuple, steps: int) -> tuple[bool, int, int]:
    """Whether values (else ids) are narrowed next, from where, and by which step."""
    _, low, high, id_low, id_high = area
    if low < high:
        return True, low, -(-(high - low + 1) // steps)
    return False, id_low, -(-(id_high - id_low + 1) // steps)


def _inside(area: tuple, placed: Sequence[Column]) -> Column:
    want, low, high, id_low, id_high = area
    inside = placed[want].between(low, high)
    return inside & F.col("id").between(id_low, id_high) if low == high else inside


def _fetch(keys: DataFrame, placed: Sequence[Column], searches: dict, areas: list) -> None:
    """Look at the few rows that are left."""
    hits = [F.when(_inside(a, placed), F.struct(F.lit(n).alias("area"), placed[a[0]].alias("value"), F.col("id").alias("id")))
            for n, a in enumerate(areas)]
    left = keys.select(F.explode(F.array_compact(F.array(*hits))).alias("h")).select("h.*").toPandas()
    for key, search in list(searches.items()):
        if not search.found:
            mine = left[left["area"] == areas.index(search.area)]
            at = np.lexsort((mine["id"], mine["value"]))[search.need - 1]
            value, row_id = int(mine["value"].iloc[at]), int(mine["id"].iloc[at])
            searches[key] = replace(search, low=value, high=value, id_low=row_id, id_high=row_id)
