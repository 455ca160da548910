"""BPE encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a batch are laid out as one array of symbols. An index maps each
adjacent pair that has a merge rank to all its positions. Active ranks are applied in ascending
order; a merge touches only the lists of the pairs beside it. One merge therefore serves every
occurrence in the batch at once, and a pre-token that repeats is merged once.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plateflow.llm.frames import append, texts
from plateflow.llm.word_bpe import TokenizerFile, Vocabulary

#: Distinct pre-tokens laid out at once; bounds the arrays, not the result.
LAYOUT = 200_000
#: Bytes of text worked on at once, one text at least; bounds what a worker holds, not the result.
BYTES_AT_ONCE = 1 << 20


def merge_words(vocabulary: Vocabulary, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all ``words`` one after the other (int32), and where each word's begin (length + 1)."""
    ids, sizes = [], []
    for start in range(0, len(words), LAYOUT):
        some, lengths = _merge(vocabulary, words[start:start + LAYOUT])
        ids.append(some)
        sizes.append(lengths)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    starts = np.zeros(len(words) + 1, np.int64)
    if sizes:
        np.cumsum(np.concatenate(sizes), out=starts[1:])
    return flat, starts


def _merge(vocabulary: Vocabulary, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    laid, sizes = vocabulary.symbols(words)
    n = len(laid)
    symbol = np.append(laid, np.int32(-1))
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # Links to the neighbours inside the word; n stands for none and holds no symbol.
    after = np.arange(1, n + 2, dtype=np.int32)
    before = np.arange(-1, n, dtype=np.int32)
    last = np.cumsum(sizes) - 1
    after[last] = after[n] = n
    before[last - sizes + 1] = before[n] = n

    merges, base = vocabulary.merges, len(vocabulary.token_of) + 1
    keyed = {left * base + right: (rank, merged) for (left, right), (rank, merged) in merges.items()} \
        if not hasattr(vocabulary, "keyed") else vocabulary.keyed
    vocabulary.keyed = keyed

    positions: dict[int, list[np.ndarray]] = {}  # pair -> positions of its left symbol
    active: list[tuple[int, int]] = []  # (rank, pair), a heap

    def note(at: np.ndarray) -> None:
        """Enter the pairs that begin at these positions."""
        at = at[after[at] != n]
        if not len(at):
            return
        pairs = symbol[at].astype(np.int64) * base + symbol[after[at]]
        order = np.argsort(pairs, kind="stable")
        pairs, at = pairs[order], at[order]
        edges = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        for pair, lo, hi in zip(pairs[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(at)], strict=True):
            known = positions.get(pair)
            if known is not None:
                known.append(at[lo:hi])
            elif (found := keyed.get(pair)) is not None:
                positions[pair] = [at[lo:hi]]
                heapq.heappush(active, (found[0], pair))

    note(np.arange(n, dtype=np.int32))
    while active:
        _, pair = heapq.heappop(active)
        at = np.concatenate(positions.pop(pair))
        left, right = divmod(pair, base)
        # An entry is stale once a neighbour's merge took one of its symbols.
        at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
        if not len(at):
            continue
        at = np.unique(at)
        if left == right:
            at = _leftmost(at, after)
        merged = keyed[pair][1]
        gone = after[at]
        symbol[at] = merged
        symbol[gone] = -1
        beyond = after[gone]
        after[at] = beyond
        inside = beyond != n
        before[beyond[inside]] = at[inside]
        note(np.unique(np.concatenate([before[at][before[at] != n], at])))
    alive = symbol[:n] >= 0
    return symbol[:n][alive], np.bincount(word[alive], minlength=len(sizes))


def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping pairs of one symbol (aaa) the leftmost each time; ``at`` ascends."""
    taken, used = [], -1
    for position in at.tolist():
        if position != used:
            taken.append(position)
            used = int(after[position])
    return np.array(taken, dtype=at.dtype)


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Batch:
    """The texts of a batch as numbered words, and the tokens of each distinct word."""

    def __init__(self, vocabulary: Vocabulary, column: pa.Array) -> None:
        numbers, words = Numbers(), vocabulary.words
        self.rows = [np.fromiter(map(numbers.__getitem__, words(t)), np.int32) for t in texts(column)]
        self.vocabulary = vocabulary
        self.ids, self.starts = merge_words(vocabulary, list(numbers))
        self.sizes = np.diff(self.starts)

    def encoded(self, row: np.ndarray) -> np.ndarray:
        """The ids of a whole text, in order."""
        sizes = self.sizes[row]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(self.starts[row] - ends + sizes, sizes)
        return self.ids[place]


def encode(docs: DataFrame, tokenizer: TokenizerFile, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``ids`` array<int>: the tokens of each whole text. Null and empty texts have none."""

    def make():
        vocabulary = tokenizer.load()

        def compute(columns):
            batch = Batch(vocabulary, columns[0])
            return [pa.array([batch.encoded(r) for r in batch.rows], pa.list_(pa.int32()))]

        return compute

    return append(docs, [text], "ids array<int>", make, keep, BYTES_AT_ONCE)


def decode(encoded: DataFrame, tokenizer: TokenizerFile, ids: str = "ids", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``decoded`` string: the tokens' strings joined by spaces, special ones too.

    Ids that the vocabulary does not have are passed over; a null list gives the empty text.
    """

    def make():
        token_of = tokenizer.load().token_of

        def compute(columns):
            return [[" ".join(token_of[i] for i in row or () if i in token_of) for row in columns[0].to_pylist()]]

        return compute

    return append(encoded, [ids], "decoded string", make, keep)


def round_trip(docs: DataFrame, tokenizer: TokenizerFile, text: str = "text", keep: Sequence[str] = (),
               with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again, as digests.

    Returns the ``keep`` columns and ``n_tokens`` long, ``ids_sha256`` (the ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` (UTF-8 of what ``decode`` gives), and with
    ``with_ids`` also ``ids`` array<int>. Null counts as
    empty; repeated rows each have their result; an empty table gives an empty result. A text of
    any length is processed whole. A kept column named like an output is replaced by it.
    """

    def make():
        vocabulary = tokenizer.load()
        token_of = vocabulary.token_of

        def compute(columns):
            batch = Batch(vocabulary, columns[0])
            tokens = list(map(token_of.__getitem__, batch.ids.tolist()))
            starts = batch.starts.tolist()
            # Decoding joins by spaces, so a text's decoding is that of its words, joined.
            spelt = [" ".join(tokens[lo:hi]) for lo, hi in zip(starts, starts[1:], strict=False)]
            del tokens
            counts, ids_digest, text_digest, every = [], [], [], []
            for row in batch.rows:
                ids = batch.encoded(row)
                counts.append(len(ids))
                if with_ids:
                    every.append(ids)
                ids_digest.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded = " ".join(map(spelt.__getitem__, row.tolist()))
                text_digest.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            arrays = [pa.array(every, pa.list_(pa.int32()))] if with_ids else []
            return counts, ids_digest, text_digest, *arrays

        return compute

    outputs = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return append(docs, [text], outputs, make, keep, BYTES_AT_ONCE)
