"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

The words of all items are numbered, and every window of 13 consecutive item words is a key of the
automaton, which so takes one node a word. It is built once, on the driver, and sent to the workers.
Each text is scanned once: words become numbers, and stretches in which any two neighbours are
neighbours in some item run through the automaton. Matches are intervals of word numbers, and these
are mapped back to code point offsets of the text as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import repeat

import ahocorasick
import numpy as np
from pyspark import SparkContext
from pyspark.sql import DataFrame, functions as F

from plateflow.llm.frames import append, column, discard, kept, scratch, stored, texts
from plateflow.session import cut

#: Words in a window; an item of fewer is one window.
WINDOW = 13
#: Normalised bytes of items in one automaton. 1 MB of items took 100 MB in every worker, 74 MB to send and
#: 1.9 s to build; larger parts make several automata.
AUTOMATON_BYTES = 2 << 20
#: Bytes of items sent to the workers at once; a larger benchmark is scanned in several passes.
PASS_BYTES = 2 << 20

#: Bytes of UTF-8: A-Z to a-z; digits, letters and everything beyond ASCII stay; the rest separates.
TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))

Item = tuple[str, str]  # id, text


def windows(words: Sequence, size: int = WINDOW) -> list[tuple]:
    if not words:
        return []
    if len(words) < size:
        return [tuple(words)]
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]


def automata(items: Sequence[Item], size: int, most: int) -> list[list[tuple[str, bytes]]]:
    """The items in groups of at most ``most`` normalised bytes (or one item)."""
    groups: list[list[tuple[str, bytes]]] = []
    room = 0
    for name, text in items:
        words = text.encode("utf-8").translate(TO_WORDS).split()
        if not words:
            continue
        normal = b" ".join(words)
        # A single long item is cut where its windows overlap, so that none is lost.
        for start in range(0, max(1, len(words) - size + 1), max(1, most // 8)):
            piece = normal if len(normal) <= most else b" ".join(words[start:start + max(1, most // 8) + size - 1])
            if not groups or room < len(piece):
                groups.append([])
                room = most
            groups[-1].append((name, piece))
            room -= len(piece)
            if piece is normal:
                break
    return groups


class Scanner:
    """One automaton: numbers of words, windows as sequences of numbers, and which words are neighbours."""

    def __init__(self, group: Sequence[tuple[str, bytes]], size: int) -> None:
        self.numbers: dict[bytes, int] = {}  # from 1; 0 is a word of no item
        found: dict[tuple[int, ...], list[str]] = {}
        pairs: set[tuple[int, int]] = set()
        for name, normal in group:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in normal.split(b" ")]
            pairs.update(zip(words, words[1:]))
            for window in windows(words, size):
                found.setdefault(window, []).append(name)
        self.lengths = [len(w) for w in found]
        self.names = list(found.values())
        self.least = min(self.lengths)
        self.base = len(self.numbers) + 1
        self.pairs = np.array(sorted(a * self.base + b for a, b in pairs), np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for i, window in enumerate(found):
            self.automaton.add_word(window, i)
        self.automaton.make_automaton()

    def scan(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The occurrences of windows as half-open intervals of word numbers, and the items they come from."""
        marks: list[tuple[int, int]] = []
        names: set[str] = set()
        if len(words) < self.least:
            return marks, names
        numbers = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        for lo, hi in self._stretches(numbers):
            for end, which in self.automaton.iter(tuple(numbers[lo:hi].tolist())):
                marks.append((lo + end + 1 - self.lengths[which], lo + end + 1))
                names.update(self.names[which])
        return marks, names

    def _stretches(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """Intervals of words outside which no window can lie."""
        if self.least > 1:
            pairs = numbers[:-1] * self.base + numbers[1:]
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            good, more = self.pairs[at] == pairs, 1
        else:
            good, more = numbers > 0, 0
        edge = np.diff(np.concatenate([[False], good, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + more
        long = ends - starts >= self.least
        return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def _joined(intervals: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open intervals without overlaps, in order; touching ones are joined."""
    out: list[list[int]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _offsets(data: bytes, intervals: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Intervals of words as code point offsets of the text whose UTF-8 bytes are ``data``."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.frombuffer(data.translate(TO_WORDS), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [(int(points[starts[lo]]), int(points[ends[hi - 1]])) for lo, hi in intervals]


MARKS = "array<struct<first:int,last:int>>"
REPORT = "n_words long, n_hit long, items array<string>, spans array<struct<first:int,last:int>>, contaminated boolean"


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", keep: Sequence[str] = ("doc_id",), size: int = WINDOW,
                       automaton_bytes: int = AUTOMATON_BYTES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The ``keep`` columns and, for each document:

    ``n_words`` long; ``n_hit`` long, the words inside any occurrence of a window; ``items``, the
    ids of the items with occurring windows as strings in order; ``spans``, the hit passages as
    half-open code point offsets (touching ones joined); ``contaminated``: some word is hit, and
    20 * n_hit >= n_words.

    Words: A-Z lower-cased, then runs of digits, letters a-z and code points beyond ASCII. A null
    text, of document or item, has no words; an item without words matches nothing; a null item id
    is the empty string; repeated items count once; an empty benchmark hits nothing. Whole texts
    are scanned. The documents are not shuffled; with several passes they are written once a pass,
    so that the driver and a task hold the items of one pass only. Kept columns named like an output are replaced.
    """
    items = benchmark.select(F.coalesce(column(benchmark, item_id).cast("string"), F.lit("")).alias("id"),
                             column(benchmark, item_text).alias("text")).filter("text is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("id")), F.lit(0))).first()[0]
    passes = max(1, -(-total // pass_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(passes))
    # Own names for the documents' columns, so that none meets a helper's.
    own = {c: f"d{i}" for i, c in enumerate(docs.columns)}

    def scanned(frame: DataFrame, k: int) -> DataFrame:
        # Bounded by pass_bytes: a part of the items, sorted so that each pass is the same again.
        some = sorted((r.id, r.text) for r in items.filter(part == k).collect())
        last = k == passes - 1
        outputs = REPORT if last else f"marks {MARKS}, names array<string>"
        return append(frame, [own[text]] if k == 0 else [own[text], "marks", "names"], outputs,
                      _pass(some, size, automaton_bytes, last),
                      list(dict.fromkeys(own[c] for c in keep)) if last else list(dict.fromkeys(own[c] for c in [*keep, text])))

    frame = docs.toDF(*own.values())
    if passes == 1:
        frame = scanned(frame, 0)
    else:
        with scratch(docs.sparkSession) as folder:
            for k in range(passes - 1):
                # Written before the next part is fetched; what it was made from goes.
                frame = stored(scanned(frame, k), f"{folder}/pass{k}")
                if k:
                    discard(docs.sparkSession, f"{folder}/pass{k - 1}")
            frame = cut(scanned(frame, passes - 1))
    results = frame.columns[-5:]
    return frame.select(*[F.col(own[c]).alias(c) for c in kept(keep, results)], *results)


def _pass(items: Sequence[Item], size: int, most: int, last: bool):
    # Built here, once; a worker unpacks it once.
    scanners = SparkContext.getOrCreate().broadcast([Scanner(group, size) for group in automata(items, size, most)])

    def make():
        def compute(columns):
            earlier = zip(columns[1].to_pylist(), columns[2].to_pylist(), strict=True) if len(columns) > 1 else None
            rows: list[tuple] = []
            for value in texts(columns[0]):
                data = value.encode("utf-8")
                words = data.translate(TO_WORDS).split()
                marks: list[tuple[int, int]] = []
                names: set[str] = set()
                for scanner in scanners.value:
                    found, of = scanner.scan(words)
                    marks += found
                    names |= of
                if earlier is not None:
                    before, known = next(earlier)
                    marks += [(m["first"], m["last"]) for m in before]
                    names |= set(known)
                marks = _joined(marks)
                if last:
                    hit = sum(hi - lo for lo, hi in marks)
                    rows.append((len(words), hit, sorted(names), _offsets(data, marks) if marks else [],
                                 hit > 0 and 20 * hit >= len(words)))
                else:
                    rows.append((marks, sorted(names)))
            if last:
                a, b, c, d, e = zip(*rows, strict=True)
                return a, b, c, [[{"first": lo, "last": hi} for lo, hi in x] for x in d], e
            a, b = zip(*rows, strict=True)
            return [[{"first": lo, "last": hi} for lo, hi in x] for x in a], b

        return compute

    return make


def digest(report: DataFrame) -> DataFrame:
    """``n_items`` long and ``items_sha256`` (the sorted ids, comma-joined) in place of ``items`` and ``spans``."""
    return report.withColumns({
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256),
    }).drop("items", "spans")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, all columns as they were."""
    mark = "_contaminated"
    while mark in docs.columns:
        mark += "_"
    # A column of the report may have the name of a document's; the documents' own are kept.
    names = [f"_d{i}" for i in range(len(docs.columns))]
    report = find_contamination(docs.toDF(*names), benchmark, names[docs.columns.index(text)], keep=names)
    return report.filter(~F.col("contaminated")).select(*names).toDF(*docs.columns)


