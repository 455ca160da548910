"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 to n-1 in a fixed order. A keyed permutation of these numbers is a
reproducible shuffle that needs no random sort: the row with permuted number p goes to shard
p mod s at slot p div s, so shard sizes differ by one row at most, slots have no gaps, and both
follow from the number alone. The permutation also runs backwards: which row lies at (shard, slot)
is computed without reading anything.

The network works on pairs (l, r) with l < a, r < b, a * b >= n and a, b near the square root of
n. Results of n or more are permuted again until they fall below n (cycle walking); as a * b
exceeds n by about its square root, that is rare.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from plateflow.llm.frames import append, column
from plateflow.session import cut

ROUNDS = 8


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A permutation of 0 .. n-1 fixed by ``n`` and ``seed``."""

    def __init__(self, n: int, seed: int = 0) -> None:
        self.n = n
        self.a = max(1, isqrt(max(0, n - 1)) + 1)
        self.b = max(1, -(-n // self.a))
        self.keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                         + np.uint64(seed % 2**64))

    def forward(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self._once)

    def backward(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self._undo)

    def _walk(self, numbers: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(numbers, dtype=np.uint64))
        while len(beyond := np.flatnonzero(out >= self.n)):
            out[beyond] = step(out[beyond])
        return out.astype(np.int64)

    def _sides(self) -> tuple[np.uint64, np.uint64]:
        return np.uint64(self.a), np.uint64(self.b)

    def _once(self, x: np.ndarray) -> np.ndarray:
        a, b = self._sides()
        left, right = x // b, x % b
        for i, key in enumerate(self.keys):
            if i % 2:
                right = (right + _mix(left ^ key) % b) % b
            else:
                left = (left + _mix(right ^ key) % a) % a
        return left * b + right

    def _undo(self, x: np.ndarray) -> np.ndarray:
        a, b = self._sides()
        left, right = x // b, x % b
        for i in reversed(range(ROUNDS)):
            if i % 2:
                right = (right + b - _mix(left ^ self.keys[i]) % b) % b
            else:
                left = (left + a - _mix(right ^ self.keys[i]) % a) % a
        return left * b + right


def place_of(number: int, rows: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of the row with this global number."""
    p = int(Permutation(rows, seed).forward(np.array([number]))[0])
    return p % shards, p // shards


def number_at(shard: int, slot: int, rows: int, shards: int, seed: int = 0) -> int:
    """The global number of the row at (shard, slot)."""
    p = slot * shards + shard
    if not (0 <= shard < shards and 0 <= p < rows):
        raise ValueError("no such place")
    return int(Permutation(rows, seed).backward(np.array([p]))[0])


def number_rows(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``df`` with ``row_number`` long from 0 in the order of the given columns, nulls first; and the row count.

    The rows are range-partitioned and each task counts its own; only one count per task is
    gathered. Give as few columns as possible: the rows are written once to the shared folder.
    Rows equal in all of ``order`` may take each other's numbers.
    """
    keys = [column(df, c).asc_nulls_first() for c in order]
    placed = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33).alias("_task")
    counts = placed.groupBy(task).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    # One row per shuffle task, whatever the data.
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_task", F.shiftright("_at", 33)).join(offsets, "_task")
    return numbered.withColumn(
        "row_number", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_task", "_at", "_before"), total


def shard(docs: DataFrame, shards: int = 16, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The place of every document: shard sizes at most one row apart (law ``rows``).

    Returns doc_id, size long (UTF-8 bytes of the text plus 1), text_crc32 long, law string, shard
    int, slot long, grown_shard int (null: the law is not ``key``), row_number long. Only ids,
    sizes and checksums are moved, never texts. Rows are numbered by (doc_id, checksum, size), so
    the result depends on the rows alone, not on files or partitions; repeated rows each get a
    place. A null text has size 1 and the checksum of no bytes, 0; a null doc_id sorts first. An
    empty table gives an empty result. Other columns are not read.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    value = column(docs, text)
    slim = docs.select(
        column(docs, doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(value.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    numbered, total = number_rows(slim, ["doc_id", "text_crc32", "size"])

    def make():
        permutation = Permutation(total, seed)

        def compute(columns):
            p = permutation.forward(columns[0].to_numpy(zero_copy_only=False))
            return [pa.array((p % shards).astype(np.int32)), pa.array(p // shards)]

        return compute

    placed = append(numbered, ["row_number"], "shard int, slot long", make,
                    keep=["doc_id", "size", "text_crc32", "row_number"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")
