"""Importance resampling towards a target: which documents of a corpus look like the target's texts.

Words come from bytes: one table of 256 entries lower-cases A-Z and blanks the other ASCII
characters that are neither letters nor digits, all inside UTF-8, and ``bytes.split`` gives the
words. A run of words is hashed by extending the checksum of the run one word shorter, so n-grams
are never put together. Counters reduce the checksums of some rows before anything leaves the task;
what is shuffled is at most one row per bucket and task.

A bucket's gain is the logarithm of how much more often the target holds it than the corpus, a
document's weight the mean gain of its features. Adding a Gumbel number fixed by seed and id and
taking the highest scores draws without replacement, in proportion to the exponential of the weight.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plateflow.llm.frames import append, column, texts
from plateflow.llm.sharding import number_rows
from plateflow.session import cut

#: Lower case for A-Z; a blank for every other byte below 128 that is no digit or small letter.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

BUCKETS = 10_000
#: Checksums remembered in a task; bounds memory, not the result.
REMEMBERED = 500_000


def words(text: str) -> list[bytes]:
    """The words of a whole text as UTF-8."""
    return text.encode("utf-8").translate(TABLE).split()


class Checksums(dict):
    """crc32 of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = crc32(word)
        return value

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


def features(found: Sequence[bytes], longest: int, known: Checksums) -> Iterator[list[int]]:
    """crc32 of all runs of 1, then 2, up to ``longest`` words joined by one space."""
    level = list(map(known.__getitem__, found))
    yield level
    if longest > 1:
        spaced = [b" " + w for w in found]
        for size in range(1, longest):
            level = list(map(crc32, spaced[size:], level))
            yield level


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` int, ``n`` long: how many features of all whole texts fall into each bucket; empty buckets are absent.

    Features are the runs of 1 to ``longest`` words, repeats counted. Null and empty texts have
    none, repeated rows count each, an empty table gives an empty result. Only ``text`` is read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = Checksums(), np.zeros(buckets, np.int64)
        for batch in batches:
            known.trim()
            counter: Counter[int] = Counter()
            for value in texts(batch.column(0)):
                counter.update(chain.from_iterable(features(words(value), longest, known)))
                if len(counter) > REMEMBERED:
                    _add(counter, totals)
            _add(counter, totals)
        filled = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(totals[filled])], names=["bucket", "n"])

    partial = docs.select(column(docs, text).alias("x")).mapInArrow(run, "bucket int, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def _add(counter: Counter[int], totals: np.ndarray) -> None:
    """Empty ``counter`` into ``totals``."""
    sums = np.fromiter(counter.keys(), np.int64, len(counter)) % len(totals)
    np.add.at(totals, sums, np.fromiter(counter.values(), np.int64, len(counter)))
    counter.clear()


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths, from two results of ``bucket_counts``: floor(1000 ln((t+1)(S+b) / ((s+1)(T+b)))).

    Gathers at most two numbers per bucket.
    """
    sides = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    s, t = np.zeros(buckets), np.zeros(buckets)
    for bucket, a, b in sides.groupBy("bucket").agg(F.sum("s"), F.sum("t")).collect():
        s[bucket], t[bucket] = a, b
    total_s, total_t = float(s.sum()), float(t.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (total_s + buckets) / ((a + 1) * (total_t + buckets))))
                     for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def gumbel(seed: int, doc_id) -> int:
    """A Gumbel number in thousandths, fixed by seed and id; a null id counts as the empty string."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: int = 2024, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id, n_words long, n_features long, weight long (floored mean gain, 0 without features), score long."""
    buckets = len(gain)

    def make():
        known = Checksums()

        def compute(columns):
            known.trim()
            n_words, n_features, weights, scores = [], [], [], []
            for value, key in zip(texts(columns[0]), columns[1].to_pylist(), strict=True):
                found = words(value)
                sums = np.fromiter(chain.from_iterable(features(found, longest, known)), np.int64)
                weight = int(gain[sums % buckets].sum()) // len(sums) if len(sums) else 0
                n_words.append(len(found))
                n_features.append(len(sums))
                weights.append(weight)
                scores.append(weight + gumbel(seed, key))
            return n_words, n_features, weights, scores

        return compute

    return append(docs.select(column(docs, text).alias("text"), column(docs, doc_id).alias("doc_id")), ["text", "doc_id"],
                  "n_words long, n_features long, weight long, score long", make, keep=["doc_id"])


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1,
             buckets: int = BUCKETS, seed: int = 2024, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text") -> DataFrame:
    """Draw floor(``percent`` N / 100) of the N documents with at least ``least_words`` words.

    Returns every row's doc_id, n_features, weight, score and rank (1, 2, 3 ... by score
    descending, then doc_id, then n_features; null if not drawn), all long. The texts are read
    twice, and only five numbers a row are shuffled; the order is a range shuffle, so no task
    holds more than a range of scores. A null text has no words, a null id is the empty string for
    the seed and comes first among equal scores, repeated rows are drawn each for itself, an empty
    corpus gives an empty result, an empty target a gain from the corpus alone. Other columns are
    not read.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    every = cut(weigh(docs, gain, longest, seed, doc_id, text)
                .withColumn("out", F.col("n_words") < least_words).withColumn("down", -F.col("score")))
    numbered, _ = number_rows(every, ["out", "down", "doc_id", "n_features"])
    able = every.filter(~F.col("out")).count()
    drawn = ~F.col("out") & (F.col("row_number") < percent * able // 100)
    return numbered.select("doc_id", "n_features", "weight", "score",
                           F.when(drawn, F.col("row_number") + 1).alias("rank"))
