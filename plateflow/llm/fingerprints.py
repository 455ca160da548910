"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes ends a piece wherever it hits a value that depends on the
block size; each piece gives one letter, the hash of what it holds. Insertions and deletions so
change letters nearby and leave the others. Fingerprints are compared by the edit distance of
letters made at the same block size; each holds letters for its block size and for twice that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plateflow.llm.frames import column

SPAN = 7  # bytes in the rolling hash
SMALLEST = 3  # block sizes are 3 * 2**k, so a boundary at twice a block size is also one at it
LETTERS = 64  # most letters in the first part; a 64-bit word holds an edit distance column
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
CODE = np.zeros(256, np.uint8)
CODE[ALPHABET] = np.arange(64)
PIECE = 1 << 20  # bytes hashed at a time
_STEP, _STIR, _GRAM, _LAST = np.uint32(0x01000193), np.uint32(0x85EBCA6B), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _boundaries(data: bytes, least: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Levels of the boundaries at or above level ``least``, the running sum of gram hashes at each, and at the end."""
    levels, sums = [], []
    total = np.uint64(0)
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, len(raw), PIECE):
        lead = min(start, SPAN - 1)
        part = raw[start - lead:start + PIECE].astype(np.uint32)
        rolled = part.copy()
        for k in range(1, SPAN):
            rolled *= _STEP
            rolled[k:] += part[:-k] if k < len(part) else part[:0]
        rolled = rolled[lead:]
        rolled ^= rolled >> np.uint32(15)
        rolled *= _STIR
        rolled ^= rolled >> np.uint32(13)
        running = np.cumsum(rolled * _GRAM, dtype=np.uint64)
        running += total
        value = rolled + np.uint32(1)
        at = np.flatnonzero((value & np.uint32((1 << least) - 1)) == 0)
        at = at[value[at] % np.uint32(SMALLEST) == 0]
        low = value[at] & (~value[at] + np.uint32(1))  # the lowest set bit
        levels.append(np.where(low == 0, 32, np.log2(np.maximum(low, 1))).astype(np.int64))
        sums.append(running[at])
        total = running[-1]
    if not levels:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), total
    return np.concatenate(levels), np.concatenate(sums), total


def _letters(sums: np.ndarray, total: np.uint64, most: int) -> str:
    """A letter for each piece; what lies beyond the last one allowed joins it, and the rest is the last letter."""
    ends = np.append(sums[:most - 1], total)
    pieces = np.diff(ends, prepend=np.uint64(0)) * _LAST
    pieces ^= pieces >> np.uint64(29)
    return ALPHABET[((pieces * _GRAM) >> np.uint64(58)).astype(np.int64)].tobytes().decode("ascii")


def fingerprint(text: str) -> str:
    """``blocksize:letters:letters at twice the block size``; ``3::`` for the empty text."""
    data = text.encode("utf-8")
    if not data:
        return f"{SMALLEST}::"
    level = 0
    while SMALLEST << level < -(-len(data) // LETTERS):
        level += 1
    least = max(0, level - 2)
    levels, sums, total = _boundaries(data, least)
    # Texts that repeat themselves have few boundaries; a smaller block finds more.
    while level > 0 and np.count_nonzero(levels >= level) < LETTERS // 2:
        level -= 1
        if level < least:
            least = max(0, level - 2)
            levels, sums, total = _boundaries(data, least)
    first = _letters(sums[levels >= level], total, LETTERS)
    second = _letters(sums[levels >= level + 1], total, LETTERS // 2)
    return f"{SMALLEST << level}:{first}:{second}"


def edit_distances(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """Levenshtein distances of strings of at most 64 letters, all pairs side by side, one bit a row."""
    n = len(pairs)
    m = np.array([len(a) for a, _ in pairs], np.int64)
    k = np.array([len(b) for _, b in pairs], np.int64)
    if n == 0:
        return np.zeros(0, np.int64)

    def codes(strings: list[str]) -> np.ndarray:
        padded = "".join(s.ljust(LETTERS, "A") for s in strings).encode("ascii")
        return CODE[np.frombuffer(padded, np.uint8)].reshape(n, LETTERS)

    one, rows = np.uint64(1), np.arange(n)
    left, right = codes([a for a, _ in pairs]), codes([b for _, b in pairs])
    where = np.zeros((n, 64), np.uint64)
    for i in range(LETTERS):
        live = rows[m > i]
        where[live, left[live, i]] |= one << np.uint64(i)
    plus, minus = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    distance, top = m.copy(), np.maximum(m - 1, 0).astype(np.uint64)
    for j in range(int(k.max(initial=0))):
        live = k > j
        equal = where[rows, right[:, j]]
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(across | plus), plus & across
        step = ((up >> top) & one).astype(np.int64) - ((down >> top) & one).astype(np.int64)
        distance += np.where(live, step, 0)
        up = (up << one) | one
        down = down << one
        plus = np.where(live, down | ~(vertical | up), plus)
        minus = np.where(live, up & vertical, minus)
    return np.where(m == 0, k, distance)


def likeness(pairs: Sequence[tuple[str, str]]) -> list[float]:
    """For each pair of fingerprints, from 0 to 1: the best 1 - distance / longer length of letters at a
    block size that both have; 0 where there is none, 1 for equal fingerprints."""
    flat, owner = [], []
    out = [0.0] * len(pairs)
    for i, (a, b) in enumerate(pairs):
        if a == b:
            out[i] = 1.0
            continue
        (sa, a1, a2), (sb, b1, b2) = a.split(":"), b.split(":")
        sa, sb = int(sa), int(sb)
        for x, y, same in ((a1, b1, sa == sb), (a2, b2, sa == sb), (a1, b2, sa == 2 * sb), (a2, b1, 2 * sa == sb)):
            if same and (x or y):
                flat.append((x, y))
                owner.append(i)
    distances = edit_distances(flat)
    for i, (x, y), d in zip(owner, flat, distances.tolist(), strict=True):
        out[i] = max(out[i], 1.0 - d / max(len(x), len(y)))
    return out


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points (rounded down) replaced by as many first ones of ``following``."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness to it and to the next document's.

    The next document is that with the next doc_id (a null doc_id comes first, equal ids in order
    of their texts; the last one is followed by the first). A null text is empty. Returns the
    columns of ``SCHEMA``, one row a document; an empty table gives none. Other columns are not read.

    Documents are dealt by ranges of doc_id, those without one by ranges of the beginning of their
    text, and sorted within; each range also gets the first document of the next. Texts cross the
    network once. The driver sees one id per range.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(column(docs, doc_id).cast("long").alias("doc_id"),
                       F.coalesce(column(docs, text), F.lit("")).alias("text"))
    # Bounds only even out the ranges; any would give the same result.
    rows, named = slim.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    without = -(-ranges * (rows - named) // max(1, rows))
    starts = _bounds(slim.filter("doc_id is null").select(_beginning(F.col("text")).alias("b")), "b", without)
    bounds = _bounds(slim.select("doc_id"), "doc_id", ranges - without)
    place = F.when(F.col("doc_id").isNull(), _ascending(starts, _beginning(F.col("text")))).otherwise(
        _ascending(bounds, F.col("doc_id")) + len(starts)).cast("int")
    placed = slim.withColumn("at", place)
    ranges = len(starts) + len(bounds) + 1
    heads = {r["at"]: r["id"] for r in placed.groupBy("at").agg(F.min("doc_id").alias("id")).collect()}
    order = sorted(heads)
    before = {at: order[i - 1] for i, at in enumerate(order)}
    ids = [i for i in heads.values() if i is not None]
    first = placed.filter(F.col("doc_id").isin(ids) | F.col("doc_id").isNull())
    # In a range that has both, null ids come before its smallest id.
    key = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "text")
    first = first.groupBy("at").agg(F.min(key).alias("k"))
    target = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(F.lit(0), F.lit(0))
    first = first.select(F.col("k.doc_id").alias("doc_id"), F.col("k.text").alias("text"),
                         target[F.col("at")].alias("at"), F.lit(1).alias("extra"))
    dealt = placed.withColumn("extra", F.lit(0)).unionByName(first).repartitionById(ranges, F.col("at"))
    ordered = dealt.sortWithinPartitions("at", "extra", F.col("doc_id").asc_nulls_first(), "text")
    return ordered.select("doc_id", "text", "at", "extra").mapInArrow(_along, SCHEMA)


def _beginning(text):
    """The first seven bytes of a text as a number; texts in order have these in order."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def _bounds(values: DataFrame, name: str, ranges: int) -> list[int]:
    """At most ``ranges`` - 1 ascending bounds that cut the values into like parts, about."""
    cuts = [i / ranges for i in range(1, ranges)]
    return sorted({int(x) for x in values.approxQuantile(name, cuts, 1 / (8 * ranges))}) if cuts else []


def _ascending(bounds: Sequence[int], value):
    """How many of the ascending ``bounds`` are at or below ``value``, by binary search."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    return F.when(value < bounds[middle], _ascending(bounds[:middle], value)).otherwise(
        _ascending(bounds[middle + 1:], value) + (middle + 1))


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order; each is finished when the next one is seen."""
    open_row: tuple[int | None, str, str] | None = None  # doc_id, text, fingerprint
    for batch in batches:
        rows = []  # doc_id, n_chars, digest, fingerprint, edited fingerprint, next fingerprint
        ids, extras = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        for start in range(0, batch.num_rows, 256):
            values = batch.column(1).slice(start, 256).to_pylist()
            for i, value in enumerate(values, start):
                if extras[i] and open_row is None:
                    continue
                own = fingerprint(value)
                if open_row is not None:
                    doc, text, mark = open_row
                    other = edited(text, value)
                    rows.append((doc, len(text), hashlib.sha256(other.encode("utf-8")).hexdigest(), mark,
                                 mark if other == text else fingerprint(other), own))
                open_row = None if extras[i] else (ids[i], value, own)
        if not rows:
            continue
        doc, chars, digest, mark, changed, following = map(list, zip(*rows, strict=True))
        near_edited = likeness(list(zip(mark, changed, strict=True)))
        near_next = likeness(list(zip(mark, following, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(chars, pa.int64()), pa.array(digest), pa.array(mark), pa.array(changed),
             pa.array(near_edited, pa.float64()), pa.array(near_next, pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
