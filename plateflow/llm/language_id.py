"""Language identification by hierarchical discrimination.

A linear classifier first decides the language family; one-versus-one linear support vector
machines then separate the languages within it. Features are hashed byte n-grams of the letters of
the whole text, as square roots of their shares, so that every text is a vector of length one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plateflow.llm.frames import append, column, texts

#: Families of language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "uk"),
}
FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages}

UNKNOWN = "und"
SIZE = 1 << 12  # hashed features
GRAMS = (2, 3, 4)
PIECE = 1 << 20  # bytes hashed at a time
#: Labelled rows that the model is fitted on, over all languages; one of each where there are more languages.
SAMPLE_ROWS = 1600

_letter = regex.compile(r"\p{L}").search
_ONLY_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def features(text: str) -> np.ndarray | None:
    """The vector of a whole text; None without letters."""
    if not _letter(text):
        return None
    data = b" " + b" ".join(text.lower().encode("utf-8").translate(_ONLY_LETTERS).split()) + b" "
    raw = np.frombuffer(data, np.uint8)
    counts = np.zeros(SIZE)
    for start in range(0, len(raw), PIECE):
        part = raw[start:start + PIECE + max(GRAMS) - 1].astype(np.uint32)
        key = part
        for n in range(2, max(GRAMS) + 1):
            key = key[:-1] * np.uint32(0x01000193) + part[n - 1:]
            if n in GRAMS:
                # A gram belongs to the piece in which it begins.
                mine = key[:PIECE]
                mixed = (mine ^ (mine >> np.uint32(15))) * np.uint32(0x9E3779B1)
                counts += np.bincount(mixed >> np.uint32(20), minlength=SIZE)
    total = counts.sum()
    return np.sqrt(counts / total) if total else None


def fit_svm(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear SVM by dual coordinate descent; the last column of ``x`` is 1, classes weigh the same."""
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, positive.mean(), 1 - positive.mean())
    limit = cost / (2 * share)
    square = np.einsum("ij,ij->i", x, x)
    alpha, weights = np.zeros(len(x)), np.zeros(x.shape[1])
    random = np.random.default_rng(0)
    for _ in range(rounds):
        largest = 0.0
        for i in random.permutation(len(x)):
            gradient = y[i] * (x[i] @ weights) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), limit[i])
            if new != alpha[i]:
                largest = max(largest, abs(new - alpha[i]))
                weights += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if largest < 1e-3:
            break
    return weights.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``families`` with a row of ``family_weights`` each, and per family its languages and their pairs."""

    families: tuple[str, ...]
    family_weights: np.ndarray
    languages: dict[str, tuple[str, ...]]
    pair_weights: dict[str, np.ndarray]

    def predict(self, vector: np.ndarray | None) -> tuple[str, float]:
        if vector is None or not self.families:
            return UNKNOWN, 0.0
        vector = np.append(vector, 1.0)
        margins = self.family_weights @ vector
        best = int(np.argmax(margins))
        score = 1.0 if len(self.families) == 1 else float(_share(margins[best]))
        inside = self.languages[self.families[best]]
        if len(inside) == 1:
            return inside[0], score
        votes, strength = np.zeros(len(inside)), np.zeros(len(inside))
        weakest = np.ones(len(inside))
        for (a, b), margin in zip(combinations(range(len(inside)), 2), self.pair_weights[self.families[best]] @ vector, strict=True):
            votes[a if margin >= 0 else b] += 1
            strength[a] += margin
            strength[b] -= margin
            weakest[a] = min(weakest[a], _share(margin))
            weakest[b] = min(weakest[b], _share(-margin))
        chosen = max(range(len(inside)), key=lambda i: (votes[i], strength[i]))
        return inside[chosen], score * float(weakest[chosen])


def _share(margin: float) -> float:
    return 1.0 / (1.0 + np.exp(-3.0 * np.clip(margin, -30, 30)))


def fit(x: np.ndarray, languages: Sequence[str]) -> Model:
    """A model of the languages that occur among the labels of the rows of ``x``."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    family = np.array([FAMILY_OF.get(name, name) for name in languages])
    names = np.array(languages)
    families = tuple(sorted(set(family.tolist())))
    members = {f: tuple(sorted(set(names[family == f].tolist()))) for f in families}
    if len(families) == 1:
        weights = np.zeros((1, x.shape[1]), np.float32)
    else:
        weights = np.array([fit_svm(x, family == f) for f in families])
    pairs = {}
    for f, inside in members.items():
        rows = []
        for a, b in combinations(inside, 2):
            some = (names == a) | (names == b)
            rows.append(fit_svm(x[some], names[some] == a))
        if rows:
            pairs[f] = np.array(rows)
    return Model(families, weights, members, pairs)


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model fitted on at most ``sample_rows`` of the rows with a language, equally many of each.

    The rows are those with the smallest hash of id and text within a language. Texts become vectors
    on the executors; the driver gets ``sample_rows`` vectors of ``SIZE`` numbers at most. Rows
    without letters teach nothing. Of more languages than ``sample_rows`` each gives one row, one
    with letters if it has any: all are learned, and the vectors grow with them, the time of fitting
    with their square.
    """
    rows = labelled.select(column(labelled, doc_id).cast("string").alias("id"), column(labelled, text).alias("text"),
                           column(labelled, lang).alias("lang")).filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model((), np.zeros((0, SIZE + 1), np.float32), {}, {})
    if len(counts) > sample_rows:
        rows = rows.filter(F.col("text").rlike(r"\p{L}"))
    each = max(1, sample_rows // len(counts))
    span = 1 << 30
    # A first cut by hash, more than twice as wide as needed, keeps the sorted remainder small.
    widest = F.create_map(*[F.lit(v) for name, n in counts.items()
                            for v in (name, min(span, int(span * (2 * each + 30) / n) + span // 1000))])
    # Rows without an id have marks of their own, too.
    mark = F.xxhash64("id", "text")
    some = rows.withColumn("mark", mark).filter(F.pmod("mark", F.lit(span)) < widest[F.col("lang")])
    first = W.partitionBy("lang").orderBy(F.pmod("mark", F.lit(span)), "mark", "id", F.xxhash64("text"))
    some = some.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= each)

    def make():
        def compute(columns):
            vectors = (features(t) for t in texts(columns[0]))
            return [[None if v is None else v.astype(np.float32).tobytes() for v in vectors]]
        return compute

    got = append(some, ["text"], "vector binary", make, keep=["lang", "place"]).filter("vector is not null").collect()
    got = sorted(got, key=lambda r: (r["lang"], r["place"]))
    if not got:
        return Model((), np.zeros((0, SIZE + 1), np.float32), {}, {})
    x = np.array([np.frombuffer(r["vector"], np.float32) for r in got])
    return fit(x, [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` string and ``score`` double from 0 to 1, from the whole text alone.

    A null text or one without any letter, or a model without languages, gives ``und`` with score 0.
    One row in, one row out, without a shuffle; kept columns named like an output are replaced.
    """

    def make():
        def compute(columns):
            found = [model.predict(features(t)) for t in texts(columns[0])]
            return [name for name, _ in found], [score for _, score in found]
        return compute

    return append(docs, [text], "lang_pred string, score double", make, keep)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             keep: Sequence[str] = ("doc_id",), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Train on the labelled documents that are not held out, then predict all.

    Returns the ``keep`` columns, ``held_out`` boolean, ``lang_pred`` and ``score`` (see ``predict``).
    Labels teach; they are no input of a prediction. Without labels every document is ``und``.
    """
    out = held_out(column(docs, doc_id))
    model = train(docs.filter(~out), doc_id, text, lang, sample_rows)
    names = [f"k{i}" for i in range(len(keep))]
    frame = docs.select(*[column(docs, c).alias(n) for c, n in zip(keep, names, strict=True)],
                        out.alias("held_out"), column(docs, text).alias("text"))
    found = predict(frame, model, keep=[*names, "held_out"])
    taken = {"held_out", "lang_pred", "score"}
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True) if c.lower() not in taken],
                        "held_out", "lang_pred", "score")


def accept(docs: DataFrame, least: float = 0.05, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents in a recognised language: not ``und`` and with a score of ``least`` or more, columns as they were."""
    names = [f"d{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    frame = docs.toDF(*names)
    model = train(frame.filter(~held_out(F.col(at[doc_id]))), at[doc_id], at[text], at[lang])
    found = predict(frame, model, at[text], keep=names)
    good = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
    return found.filter(good).select(*names).toDF(*docs.columns)
