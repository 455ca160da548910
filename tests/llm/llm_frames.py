"""Small tables with every awkward case: nulls, empty and long texts, repeated rows, clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns that have the names of results or of helper columns.
CLASHES = ("shard", "slot", "row_number", "n_tokens", "ids", "lang_pred", "score", "held_out", "component_id", "n_shingles",
           "key", "n", "n_lines", "n_kept", "near", "gone", "contaminated", "spans", "items", "fingerprint", "host", "rule",
           "verdict", "headers", "block", "k0", "x0", "d0", "at", "extra", "_at", "a.b", "_hit_words", "bytes")

WORDS = "the of and to a in is it you that he was for on are with as his they be at one have this from".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(words))


def rows() -> list[tuple]:
    long_text = "\n".join(prose(100 + k, 400) for k in range(60))
    base = prose(1, 60)
    return [
        (1, base, "en", "a", len(base)),
        (1, base, "en", "a", len(base)),
        (2, base, "en", None, None),
        (3, base.replace("the", "The", 1) + " tail", "en", "a", 1),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \n\t ", "en", "b", 3),
        (7, "12 34 !!", None, "b", 8),
        (8, "one two", "en", "b", 7),
        (9, "one two", "de", "b", 7),
        (10, long_text, "en", "c", len(long_text)),
        (11, "Größe für Straße und Übung <|endoftext|> x\r\n" * 3, "de", "c", 5),
        (None, prose(7, 30), None, "c", 5),
        (12, "\u00e9\u0301 na\u00efve \U0001f600 \u4e2d\u6587 " + prose(8, 20), "fr", "c", 5),
    ]


def awkward(spark):
    """The rows with all extra columns, dealt over several partitions."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(), DOCS).repartition(3)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


def empty(spark):
    return spark.createDataFrame([], DOCS)


def table_of(df, key: str = "doc_id") -> dict:
    """Rows by key; repeated keys as a list."""
    out: dict = {}
    for row in df.collect():
        out.setdefault(row[key], []).append(row)
    return out
