from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from llm_frames import awkward, empty, prose, rows

from plateflow.llm import fingerprints as f


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("AB9+", max_size=64), st.text("AB9+", max_size=64)), max_size=20))
def test_distances(pairs):
    assert f.edit_distances(pairs).tolist() == [levenshtein(a, b) for a, b in pairs]


def boundaries(data):
    """Rolling hashes by a plain loop."""
    out = []
    for i in range(len(data)):
        window = data[max(0, i - f.SPAN + 1):i + 1][::-1]
        value = sum(b * 0x01000193 ** (f.SPAN - 1 - k) for k, b in enumerate(window)) % 2**32
        value ^= value >> 15
        value = value * 0x85EBCA6B % 2**32
        out.append(value ^ value >> 13)
    return out


def plain_fingerprint(text):
    data = text.encode()
    if not data:
        return "3::"
    hashes, level = boundaries(data), 0
    while 3 << level < -(-len(data) // 64):
        level += 1

    def ends(k):
        return [i for i, h in enumerate(hashes) if (h + 1) % 2**32 % (1 << k) == 0 and (h + 1) % 2**32 % 3 == 0]

    while level and len(ends(level)) < 32:
        level -= 1

    def letters(k, most):
        out, start = "", 0
        for end in [*[e + 1 for e in ends(k)][:most - 1], len(data)]:
            total = sum(h * 0x9E3779B97F4A7C15 for h in hashes[start:end]) * 0xD6E8FEB86659FD93 % 2**64
            total ^= total >> 29
            out += chr(f.ALPHABET[total * 0x9E3779B97F4A7C15 % 2**64 >> 58])
            start = end
        return out

    return f"{3 << level}:{letters(level, 64)}:{letters(level + 1, 32)}"


@pytest.mark.parametrize("text", ["a", "ab", "short text", "aaaaaaaaaa" * 30, prose(3, 200), prose(4, 1500), "\u00e9\u4e2d" * 100])
@pytest.mark.parametrize("piece", [50, 1 << 20])
def test_fingerprint_against_a_plain_loop(text, piece, monkeypatch):
    monkeypatch.setattr(f, "PIECE", piece)
    assert f.fingerprint(text) == plain_fingerprint(text)


def test_likeness_tells_edits_from_other_texts():
    texts = [prose(k, 300 + 50 * k) for k in range(20)]
    near = f.likeness([(f.fingerprint(a), f.fingerprint(f.edited(a, b))) for a, b in zip(texts, texts[1:], strict=False)])
    far = f.likeness([(f.fingerprint(a), f.fingerprint(b)) for a, b in zip(texts, texts[1:], strict=False)])
    assert min(near) > 0.4 > 0.3 > max(far)
    assert f.likeness([("3::", "3::"), ("3:AB:C", "96:AB:C"), ("3:ABCD:AB", "6:AB:C")]) == [1.0, 0.0, 1.0]


def expected():
    order = sorted(((i is not None, i or 0, t or "") for i, t, *_ in rows()))
    out = []
    for (some, i, text), (_, _, after) in zip(order, order[1:] + order[:1], strict=True):
        other = f.edited(text, after)
        a, b, c = f.fingerprint(text), f.fingerprint(other), f.fingerprint(after)
        near, following = f.likeness([(a, b), (a, c)])
        out.append((i if some else None, len(text), hashlib.sha256(other.encode()).hexdigest(), a, b, near, following))
    return sorted(map(str, out))


@pytest.mark.parametrize("partitions", ["1", "5", "13"])
def test_awkward_rows(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sorted(map(str, map(tuple, f.fingerprints(awkward(spark)).collect()))) == expected()
        assert f.fingerprints(empty(spark)).collect() == []
        one = spark.createDataFrame([(5, "abcdefgh" * 20)], "doc_id int, text string")
        assert f.fingerprints(one).first().near_next == 1.0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_documents_without_id_are_spread(spark):
    docs = [(None if k % 3 == 0 else k, prose(k, 12)) for k in range(300)] + [(None, ""), (None, None), (None, "\U0001f600")]
    order = sorted(((i is not None, i or 0, t or "") for i, t in docs))
    want = []
    for (some, i, text), (_, _, after) in zip(order, order[1:] + order[:1], strict=True):
        other = f.edited(text, after)
        a, b, c = f.fingerprint(text), f.fingerprint(other), f.fingerprint(after)
        want.append(str((i if some else None, len(text), hashlib.sha256(other.encode()).hexdigest(), a, b, *f.likeness([(a, b), (a, c)]))))
    got = f.fingerprints(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(want)
    from pyspark.sql import functions as F
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
