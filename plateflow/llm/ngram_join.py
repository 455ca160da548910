"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are the rows of an incidence matrix, their distinct word n-grams its columns. Only
columns that two different rows share can give an overlap, and by the size of a row all but its
rarest quarter of columns can be left out: a pair at or above the threshold shares one of those.

1. A sketch of fixed size counts the n-grams, which fixes an order of columns, rare ones first.
2. Every row gives its leading columns. Columns of a single row are dropped.
3. Each row is compared with one row of its columns, the one whose leading columns are shared
   most. That links most members of a group of near copies at the price of one comparison each.
4. Columns are multiplied in tiles of bounded size, where rows are still in different components;
   pairs below the bounds that follow from their sizes and positions are discarded, pairs within
   a component are not formed. What is left is compared exactly.

Equal sets are one row from the start. No pair is lost: step 4 meets every pair above the
threshold that step 3 has not already put into one component.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from plateflow.llm.components import connected
from plateflow.llm.frames import bitmap, column, discard, in_bitmap, scratch, stored, texts
from plateflow.session import cut

WORDS = 5
#: Similarity as a fraction, so that bounds are exact.
ABOVE, OF = 75, 100
SKETCH_BITS = 25  # counters of the sketch, one byte each: 32 MB for every worker
MARK_FACTOR = 64  # bits for each of what is marked in a bit array sent to every worker,
MOST_BITS = 29  # which has 64 MB at most; beyond that it lets more through and loses nothing
PAIRS_SENT = 500_000  # pairs, or names of large columns, sent to every worker at once, 24 MB; more are joined by a shuffle
TILE = 512  # rows on each side of a tile
GROUP = 256  # rows compared with the same row in one task
ROWS_COUNTED = 256  # texts whose n-grams are counted at once

#: A-Z to a-z, white space to spaces.
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
PIECE = 1 << 18  # bytes hashed at a time; a worker keeps 32 times as many in tables
#: A polynomial hash modulo 2**64: a number for each byte, an odd base, its powers and its inverse's.
_BYTES = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 3


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, 2 * PIECE), _powers(pow(_BASE, -1, 1 << 64), 2 * PIECE)


def _spans(data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[begins[i]:ends[i]]; spans start within PIECE of the first one."""
    powers, inverse = _tables() if len(data) <= 2 * PIECE else (_powers(_BASE, len(data)), _powers(pow(_BASE, -1, 1 << 64), len(data)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[np.frombuffer(data, np.uint8)] * powers[:len(data)], out=sums[1:])
    value = (sums[ends] - sums[begins]) * inverse[begins]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes (int64, ascending as unsigned, distinct) of the word n-grams of a whole text.

    A-Z is lower-cased; words are what stands between spaces, tabs, line ends, vertical tabs and
    form feeds. Fewer words than ``words`` make one n-gram, none makes none.
    """
    joined = text.encode("utf-8").translate(_LOWER).strip(b" ")
    if not joined:
        return np.zeros(0, np.int64)
    if b"  " in joined:
        joined = b" ".join(joined.split())
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    size = min(words, len(spaces) + 1)
    begins, ends = np.zeros(len(spaces) + 2 - size, np.int64), np.full(len(spaces) + 2 - size, len(joined), np.int64)
    begins[1:] = spaces[:len(begins) - 1] + 1
    ends[:-1] = spaces[size - 1:]
    hashes = []
    at = 0
    while at < len(begins):
        # Spans that begin in the same piece; a hash does not depend on where its span lies.
        until = int(np.searchsorted(begins, begins[at] + PIECE))
        base = int(begins[at])
        hashes.append(_spans(joined[base:int(ends[until - 1])], begins[at:until] - base, ends[at:until] - base))
        at = until
    out = np.sort(np.concatenate(hashes))
    return out[np.append(True, out[1:] != out[:-1])].view(np.int64)


def row_key(hashes: np.ndarray) -> int:
    """A 64-bit name of a set of hashes; equal sets have equal names."""
    value = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return value - (1 << 64) if value >> 63 else value


def leading(hashes: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The columns by which a row can be found, rare ones first."""
    n = len(hashes)
    keep = n - -(-ABOVE * n // OF) + 1 if n else 0
    counts = sketch[(hashes.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    return hashes[np.argsort(counts, kind="stable")[:keep]]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _count(docs: DataFrame, words: int) -> np.ndarray:
    """The sketch: how many n-grams fall to each counter, as codes.

    A task counts up to 255; its counters are added as whole numbers, in two steps of as many parts each as
    the root of the number of tasks.
    """
    size, blocks = 1 << SKETCH_BITS, 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint8)
        seen, salt = False, isqrt(TaskContext.get().partitionId())
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_COUNTED):
                sets = [shingles(t, words) for t in texts(batch.column(0).slice(start, ROWS_COUNTED))]
                hashes = np.concatenate(sets).view(np.uint64)
                if len(hashes):
                    seen = True
                    _add(total, (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(blocks), pa.int32()), pa.array([salt] * blocks, pa.int32()),
                 pa.array([_packed(p) for p in np.split(total, blocks)], pa.binary())], names=["block", "salt", "counts"])

    def add(key, frame):
        import pandas as pd

        total = np.zeros(size // blocks, np.int64)
        for counts in frame["counts"]:
            total += _unpacked(counts)
        # An order needs no more than 31 bits.
        total = np.minimum(total, 2**31 - 1).astype(np.int32)
        return pd.DataFrame({"block": [int(key[0])], "salt": [0], "counts": [_packed(total)]})

    schema = "block int, salt int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    parts = parts.groupBy("block", "salt").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    out = np.zeros(size, np.uint8)
    width = size // blocks
    for row in parts.collect():
        out[row["block"] * width:(row["block"] + 1) * width] = _coded(_unpacked(row["counts"]))
    return out


def _add(total: np.ndarray, places: np.ndarray) -> None:
    """Count ``places`` in counters of one byte, which stop at 255."""
    places, times = np.unique(places, return_counts=True)
    total[places] = np.minimum(total[places] + times, 255)


def _coded(counts: np.ndarray) -> np.ndarray:
    """Counts up to 2**31 as one byte each, in the same order: exact up to 127, then in steps of an eighth or less."""
    steps = np.floor(128 + 5.25 * np.log2(np.maximum(counts, 128) / 128))
    return np.where(counts < 128, counts, steps).astype(np.uint8)


def _packed(counts: np.ndarray) -> bytes:
    """Counters, a multiple of 8: a bit each for those above 0, and these in as few bytes each as the largest takes."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    there = counts > 0
    coder = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    bits = coder.compress(np.packbits(there).tobytes()) + coder.flush()
    return bytes([kind.itemsize]) + len(bits).to_bytes(4, "little") + bits + zlib.compress(counts[there].astype(kind).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    end = 5 + int.from_bytes(data[1:5], "little")
    there = np.unpackbits(np.frombuffer(zlib.decompress(data[5:end]), np.uint8)).view(bool)
    out = np.zeros(len(there), f"<u{data[0]}")
    out[there] = np.frombuffer(zlib.decompress(data[end:]), out.dtype)
    return out


def _features(docs: DataFrame, sketch, words: int) -> DataFrame:
    """doc_id, t (hash of the text), key, n and the leading columns of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            sets = [shingles(t, words) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([row_key(s) for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), _lists([leading(s, counts) for s in sets])],
                names=["doc_id", "t", "key", "n", "columns"])

    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(
        run, "doc_id long, t long, key long, n long, columns array<long>")


def _entries(features: DataFrame, marked, bits: int) -> DataFrame:
    """(g, key, n, left, reach, share) for the leading columns that may be shared.

    ``left``: the columns of the row from this one on. ``reach``: this one, the marked leading ones
    after it, and all that follow the leading ones. ``share``: marked ones in a thousand.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = marked.value
        for batch in batches:
            lists, keys, sizes = batch.column(2), batch.column(0).to_numpy(), batch.column(1).to_numpy()
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy()[offsets[0]:offsets[-1]]
            offsets -= offsets[0]
            # Equal sets once a batch is enough here; the rest meets below.
            fresh = np.zeros(len(keys), bool)
            fresh[np.unique(keys, return_index=True)[1]] = True
            lengths = np.diff(offsets)
            row = np.repeat(np.arange(len(keys)), lengths)
            place = np.arange(len(flat)) - offsets[row]
            hit = in_bitmap(array, bits, flat)
            before = np.append(0, np.cumsum(hit))
            after = before[offsets[row + 1]] - before[1:]
            share = (1000 * (before[offsets[1:]] - before[offsets[:-1]]) // np.maximum(lengths, 1)).astype(np.int32)
            at = np.flatnonzero(hit & fresh[row])
            own = row[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[at]), pa.array(keys[own]), pa.array(sizes[own]),
                 pa.array((sizes[own] - place[at]).astype(np.int32)),
                 pa.array((1 + after[at] + sizes[own] - lengths[own]).astype(np.int32)), pa.array(share[own])],
                names=["g", "key", "n", "left", "reach", "share"])

    return features.select("key", "n", "columns").mapInArrow(
        run, "g long, key long, n long, left int, reach int, share int")


def _bits(marked: int) -> int:
    """The size of a bit array for so many marks, as a power of two."""
    return min(MOST_BITS, max(16, (marked * MARK_FACTOR).bit_length()))


def _sets(docs: DataFrame, marked, bits: int, words: int) -> DataFrame:
    """key and hashes of the rows whose key has its bit set in ``marked``, some of them twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = marked.value
        for batch in batches:
            sets = [shingles(t, words) for t in texts(batch.column(0))]
            names = np.array([row_key(s) for s in sets], np.int64)
            _, first = np.unique(names, return_index=True)
            at = [i for i in first.tolist() if len(sets[i]) and in_bitmap(array, bits, names[i:i + 1])[0]]
            yield pa.RecordBatch.from_arrays([pa.array(names[at]), _lists([sets[i] for i in at])], names=["key", "hashes"])

    return docs.select("text").mapInArrow(run, "key long, hashes array<long>")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups one after the other, in each its center first: the members that are similar enough, by the whole sets."""
    group, center = None, np.zeros(0, np.uint64)
    for batch in batches:
        centers, parts, members = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        lists = batch.column(3)
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        pairs = []
        for i, name in enumerate(zip(centers.tolist(), parts.tolist(), strict=True)):
            own = flat[offsets[i]:offsets[i + 1]]
            if members[i] == centers[i]:
                group, center = name, own.copy()
            elif group == name and len(own):
                at = np.searchsorted(center, own)
                shared = int(np.count_nonzero(center[np.minimum(at, len(center) - 1)] == own))
                if OF * shared >= ABOVE * (len(center) + len(own) - shared):
                    pairs.append((name[0], int(members[i])))
        if pairs:
            a, b = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _links(docs: DataFrame, pairs: DataFrame, words: int, path: str) -> DataFrame:
    """Those of the ``pairs`` (a, b) whose sets are similar enough, by the whole sets; written to ``path``.

    Of a pair the row with more pairs is the center: it lies where its members come to, once for
    ``GROUP`` of them. So a set moves once for each pair that it is the lesser row of, and no group is large.
    """
    spark = docs.sparkSession
    both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    degree = both.select(F.col("a").alias("key")).union(both.select("b")).groupBy("key").agg(F.count(F.lit(1)).alias("d"))
    degree = stored(degree, f"{path}-degree")
    ranked = both.join(degree.select(F.col("key").alias("a"), F.col("d").alias("da")), "a").join(
        degree.select(F.col("key").alias("b"), F.col("d").alias("db")), "b")
    first = F.col("da") >= F.col("db")
    roles = ranked.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("center"),
                          F.when(first, F.col("b")).otherwise(F.col("a")).alias("member"),
                          F.call_function("div", F.greatest("da", "db") - 1, F.lit(GROUP)).alias("parts"))
    roles = roles.withColumn("part", F.pmod(F.col("member"), F.col("parts") + 1)).drop("parts")
    sides = roles.select(F.col("member").alias("key"), "center", "part").union(
        roles.select(F.col("center").alias("key"), "center", "part").distinct())
    sides = stored(sides, f"{path}-sides")
    bits = _bits(degree.count())
    marked = spark.sparkContext.broadcast(bitmap(degree, "key", bits))
    sets = _sets(docs, marked, bits, words)
    few = sides.count() <= PAIRS_SENT
    # A row that several texts have sends its set from each of them; the comparison may then say so twice.
    met = sets.join(F.broadcast(sides) if few else sides, "key").select("center", "part", F.col("key").alias("member"), "hashes")
    order = ["center", "part", F.col("member") != F.col("center"), "member"]
    links = met.repartition("center", "part").sortWithinPartitions(*order).mapInArrow(_compare, "a long, b long")
    links = stored(links.distinct(), path)
    marked.destroy()
    for part in ("degree", "sides"):
        discard(spark, f"{path}-{part}")
    return links


def _bounds(x: str, y: str) -> Column:
    """Whether two entries of a column may be the first one that rows above the threshold share.

    By their sizes; by what is left of both from here on; and by their reach. Of two rows, the one
    whose leading columns end first has all it shares up to there among the other's leading ones
    too, where they are marked, so one of the two reaches holds for both.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    need = F.ceil((n + m) * ABOVE / (ABOVE + OF) - F.lit(1e-9))
    return ((OF * F.least(n, m) >= ABOVE * F.greatest(n, m)) & (F.least(f"{x}.left", f"{y}.left") >= need)
            & (F.greatest(f"{x}.reach", f"{y}.reach") >= need))


def _one_each(entries: DataFrame) -> DataFrame:
    """Pairs (a, b): every row with the row of its columns that it meets most, of those most shared."""
    middle = entries.groupBy("g").agg(F.max(F.struct("share", "n", "key", "left", "reach")).alias("m")).select("g", "m.*")
    e, m = entries.alias("e"), middle.alias("m")
    met = e.join(m, (F.col("e.g") == F.col("m.g")) & (F.col("e.key") != F.col("m.key")) & _bounds("e", "m"))
    often = met.groupBy(F.col("e.key").alias("a"), F.col("m.key").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    return often.groupBy("a").agg(F.max(F.struct("times", "b")).alias("x")).select("a", F.col("x.b").alias("b"))


def _remaining(entries: DataFrame, roots: DataFrame, path: str) -> DataFrame:
    """Pairs (a, b) of different components that share a leading column and pass the bounds.

    A column of up to ``TILE`` rows is a tile. Of a larger one, the rows of its largest component (side 0)
    meet only the other rows (side 1); those also meet each other. Both sides are cut into chunks, and each
    two chunks are a tile.
    """
    known = roots.select(F.col("node").alias("key"), "root")
    large = stored(entries.groupBy("g").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > TILE).select("g"), path)
    n_large = large.count()
    sent = F.broadcast(large) if n_large <= PAIRS_SENT else large

    def rooted(some: DataFrame) -> DataFrame:
        return some.join(known, "key", "left").withColumn("root", F.coalesce("root", "key"))

    whole = rooted(entries.join(sent, "g", "left_anti") if n_large else entries).select(
        F.col("g").alias("tile"), F.lit(2).cast("byte").alias("part"), "key", "root", F.col("n").cast("int").alias("n"), "left", "reach")
    tiles = whole.union(_cut_tiles(rooted(entries.join(sent, "g", "left_semi")))) if n_large else whole
    dealt = tiles.repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(_multiply, "a long, b long").distinct()


def _cut_tiles(rows: DataFrame) -> DataFrame:
    """The tiles of large columns, a row for each row that a tile has."""
    sizes = rows.groupBy("g", "root").agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.groupBy("g").agg(F.max(F.struct("rows", "root")).alias("m"), F.sum("rows").alias("all"))
    sizes = sizes.select("g", F.col("m.root").alias("main"), F.ceil(F.col("m.rows") / TILE).alias("chunks0"),
                         F.ceil((F.col("all") - F.col("m.rows")) / TILE).alias("chunks1")).filter("chunks1 > 0")
    rows = rows.join(sizes, "g").withColumn("side", (F.col("root") != F.col("main")).cast("int"))
    chunk = F.pmod(F.xxhash64("key"), F.when(F.col("side") == 0, F.col("chunks0")).otherwise(F.col("chunks1")))
    rows = rows.withColumn("chunk", chunk)
    # Sides 0 and 1 meet in tiles of kind 0 (i of side 0, j of side 1); in kind 1 chunk i meets chunk j of side 1,
    # or all meet where these are one. A row's part in a tile says whom it meets: those of the other part, all if 2.
    def tile(kind: int, i: Column, j: Column, part: Column) -> Column:
        return F.struct(F.xxhash64(F.col("g"), F.lit(kind), i, j).alias("tile"), part.cast("byte").alias("part"))

    zero = F.lit(0).cast("long")
    mine = F.col("chunk")
    mixed = F.transform(F.sequence(zero, F.col("chunks1") - 1), lambda j: tile(0, mine, j, F.lit(0)))
    others = F.concat(
        F.transform(F.sequence(zero, F.col("chunks0") - 1), lambda i: tile(0, i, mine, F.lit(1))),
        F.transform(F.sequence(zero, F.col("chunks1") - 1), lambda j: tile(
            1, F.least(mine, j), F.greatest(mine, j), F.when(mine == j, 2).when(mine < j, 0).otherwise(1))))
    tiles = rows.select(F.explode(F.when(F.col("side") == 0, mixed).otherwise(others)).alias("t"), "key", "root", "n", "left", "reach")
    return tiles.select("t.tile", "t.part", "key", "root", F.col("n").cast("int").alias("n"), "left", "reach")


def _main_last(root: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which each tile has its largest component last, and which rows are of it."""
    sizes = np.diff(edges)
    tile = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((root, tile))
    runs = np.flatnonzero(np.append(True, (root[order][1:] != root[order][:-1]) | (tile[1:] != tile[:-1])))
    lengths = np.diff(np.append(runs, len(root)))
    of = tile[runs]
    # The last of a tile's runs by length is its main one.
    ranked = np.lexsort((lengths, of))
    mains = np.zeros(len(runs), bool)
    mains[ranked[np.append(of[1:] != of[:-1], True)]] = True
    main = np.repeat(mains, lengths)
    last = np.lexsort((main, tile))
    return order[last], main[last]


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles come one after the other, all of a batch are multiplied together.

    Pairs that several columns give are sent once while they are remembered.
    """
    rest: list[np.ndarray] | None = None
    sent = np.zeros((0, 2), np.int64)

    def good(rows: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        _, part, _, root, n, left, reach = rows
        meet = ((part[x] != part[y]) | (part[x] == 2)) & (root[x] != root[y])
        small, large = np.minimum(n[x], n[y]).astype(np.int64), np.maximum(n[x], n[y]).astype(np.int64)
        need = -(-ABOVE * (small + large) // (ABOVE + OF))
        return (meet & (OF * small >= ABOVE * large) & (np.minimum(left[x], left[y]) >= need)
                & (np.maximum(reach[x], reach[y]) >= need))

    def found(rows: list[np.ndarray], edges: np.ndarray) -> np.ndarray:
        """Pairs of all tiles: each row with the k-th after it, for every k, while that is in its tile.

        The rows of a tile's largest component do not meet each other. They come last and ask nothing.
        """
        order, main = _main_last(rows[3], edges)
        rows = [r[order] for r in rows]
        end = np.repeat(edges[1:], np.diff(edges))
        at, pairs, k = np.flatnonzero(~main), [np.zeros((0, 2), np.int64)], 0
        while True:
            k += 1
            at = at[at + k < end[at]]
            if not len(at):
                break
            ok = at[good(rows, at, at + k)]
            a, b = rows[2][ok], rows[2][ok + k]
            pairs.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
        return np.unique(np.concatenate(pairs), axis=0)

    def flush(rows: list[np.ndarray], edges: np.ndarray):
        nonlocal sent
        pairs = found(rows, edges)
        both = np.concatenate([sent, pairs])
        _, first = np.unique(both, axis=0, return_index=True)
        fresh = both[np.sort(first[first >= len(sent)])]
        if len(fresh):
            sent = fresh if len(both) > 1_000_000 else np.concatenate([sent, fresh])
            yield pa.RecordBatch.from_arrays([pa.array(fresh[:, 0]), pa.array(fresh[:, 1])], names=["a", "b"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate([r, c]) for r, c in zip(rest, columns, strict=True)]
        edges = np.append(0, np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1)
        if edges[-1]:
            yield from flush([c[:edges[-1]] for c in columns], edges)
        # The last tile may go on in the next batch.
        rest = [c[edges[-1]:] for c in columns]
    if rest is not None:
        yield from flush(rest, np.array([0, len(rest[0])]))


def _linked(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Every row as (doc_id, t, key, n), t being a hash of its text; and (node, root) of the keys that are linked."""
    spark = docs.sparkSession
    with scratch(spark) as folder:
        sketch = spark.sparkContext.broadcast(_count(docs, words))
        features = stored(_features(docs, sketch, words), f"{folder}/features")
        sketch.destroy()
        listed = cut(features.select("doc_id", "t", "key", "n"))
        # Columns that two different rows share, found from the smallest and the largest key.
        every = features.select("key", F.explode("columns").alias("g"))
        # 32 bits of each are enough to tell, as what is marked by mistake is found out below; the
        # row's bits differ from column to column, so no two rows are taken for one throughout.
        top = F.shiftright("g", 32).cast("int")
        tag = F.hash("key", "g")
        shared = every.select(top.alias("top"), tag.alias("tag")).groupBy("top").agg(
            F.min("tag").alias("lo"), F.max("tag").alias("hi")).filter("lo != hi").select(
            F.shiftleft(F.col("top").cast("long"), 32).alias("g"))
        shared = stored(shared, f"{folder}/shared")
        bits = _bits(shared.count())
        marked = spark.sparkContext.broadcast(bitmap(shared, "g", bits))
        entries = _entries(features, marked, bits).groupBy("g", "key").agg(
            *[F.min(c).alias(c) for c in ("n", "left", "reach", "share")])
        entries = stored(entries, f"{folder}/entries")
        marked.destroy()
        for part in ("features", "shared"):
            discard(spark, f"{folder}/{part}")
        pairs = stored(_one_each(entries), f"{folder}/pairs1")
        first = _links(docs, pairs, words, f"{folder}/links1")
        others = stored(_remaining(entries, connected(first), f"{folder}/large"), f"{folder}/pairs2")
        roots = connected(first.union(_links(docs, others, words, f"{folder}/links2")))
    return listed, roots


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """The components of documents linked by a Jaccard similarity of 0.75 or more of their word n-grams.

    Returns one row a document: doc_id long, n_shingles long (distinct n-grams; fewer words than
    ``words`` are one n-gram), component_id long (the smallest doc_id reachable by links, its own
    included). A null text, or one without words, has no n-grams and is linked with nothing.
    Repeated rows are linked with each other. A null doc_id is passed over in the smallest one
    unless the whole component has no id. An empty table gives an empty result; other columns are
    not read. N-grams are compared by 64-bit hashes.
    """
    docs = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), column(docs, text).alias("text"))
    listed, roots = _linked(docs, words)
    lowest = listed.groupBy("key").agg(F.min("doc_id").alias("low"))
    grouped = lowest.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    named = grouped.join(smallest, "root").select("key", "component_id")
    return listed.join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that with the smallest (doc_id, hash of the text), all columns as they were.

    Rows decide by themselves, not by their doc_id: of several texts with one doc_id, or without
    any, each stays or goes with its own component. A null doc_id comes after all others. Rows
    equal in doc_id and text are one document and stay or go together; rows without words all stay.
    """
    names = [f"d{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    frame = docs.toDF(*names)
    number, mark = F.col(at[doc_id]).cast("long"), F.xxhash64(at[text])
    listed, roots = _linked(frame.select(number.alias("doc_id"), F.col(at[text]).alias("text")), WORDS)
    # The rows of a set are one from the map side on.
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t")
    own = listed.filter("n > 0").groupBy("key").agg(F.min(place).alias("low"))
    known = own.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    stay = known.groupBy("root").agg(F.min("low").alias("low")).select(
        F.col("low.doc_id").alias("of"), F.col("low.t").alias("t"))
    # Left without a match are the rows without words and those that stay.
    rows = listed.filter("n > 0").select(F.col("doc_id").alias("of"), "t").distinct()
    same = rows["of"].eqNullSafe(stay["of"]) & (rows["t"] == stay["t"])
    drop = rows.join(stay, same, "left_anti")
    return frame.join(drop, number.eqNullSafe(F.col("of")) & (mark == F.col("t")), "left_anti").select(*names).toDF(*docs.columns)
