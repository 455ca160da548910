"""Token counts with a whole-token shortcut.

Which strings encode alone as exactly one token is proved before any text is read: every
vocabulary string with a word end is merged from its bytes, and only those that come out as the
one token they spell are kept. Pre-tokens among them count one at once; the others are merged,
each distinct one once per batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark import SparkContext
from pyspark.sql import DataFrame

from plateflow.llm.bpe import Numbers, merge_words
from plateflow.llm.frames import append, texts
from plateflow.llm.word_bpe import TokenizerFile


@lru_cache(maxsize=2)
def whole_tokens(tokenizer: TokenizerFile) -> tuple[str, ...]:
    """The pre-tokens proved to be one token, special strings among them."""
    vocabulary = tokenizer.load()
    spelt = [(w, i) for i, t in vocabulary.token_of.items() if (w := vocabulary.word_of(t))]
    words = [w for w, _ in spelt]
    ids, starts = merge_words(vocabulary, words)
    one = [w for (w, i), lo, hi in zip(spelt, starts, starts[1:], strict=False) if hi - lo == 1 and ids[lo] == i]
    return (*one, *vocabulary.specials)


def count_tokens(docs: DataFrame, tokenizer: TokenizerFile, text: str = "text", limit: int = 2048,
                 keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``n_bytes`` long (UTF-8), ``n_tokens`` long, ``over_limit`` (more than ``limit``).

    Null counts as empty: no bytes, no tokens. Texts of any length count whole; repeated rows each
    have their result; an empty table gives an empty one. Kept columns named like an output are
    replaced by it.
    """

    # Proved here, once; the list travels to the workers.
    proved = SparkContext.getOrCreate().broadcast(tuple(dict.fromkeys(whole_tokens(tokenizer))))

    def make():
        vocabulary = tokenizer.load()
        single = Numbers((w, i) for i, w in enumerate(proved.value))

        def compute(columns):
            numbers = Numbers(single)
            rows, n_bytes = [], []
            for value in texts(columns[0]):
                n_bytes.append(len(value.encode("utf-8")))
                rows.append(np.fromiter(map(numbers.__getitem__, vocabulary.words(value)), np.int32))
            rest = list(numbers)[len(single):]
            _, starts = merge_words(vocabulary, rest)
            sizes = np.concatenate([np.ones(len(single), np.int64), np.diff(starts)])
            counts = [int(sizes[row].sum()) for row in rows]
            return n_bytes, counts, [c > limit for c in counts]

        return compute

    return append(docs, [text], "n_bytes long, n_tokens long, over_limit boolean", make, keep)
