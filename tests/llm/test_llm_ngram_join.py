from __future__ import annotations

import random

import numpy as np
import pytest
from llm_frames import awkward, empty, prose, rows

from plateflow.llm import ngram_join as nj
from plateflow.llm.components import connected
from plateflow.llm.frames import table


def components(rows):
    """(doc_id, shingles, component) of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
        words = [w for w in words if w]
        sets.append(frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(((doc, len(s), (low.get(find(i)) if s else doc)) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def check(spark, some):
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, nj.join(df).collect()), key=str) == components(some)


def near_copies(n, seed=0):
    rng, out = random.Random(seed), []
    for k in range(n):
        words = prose(k % 4, 80).split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        start = rng.choice([0, 0, 0, 5, 12])
        out.append((n - k, " ".join(words[start:]) + rng.choice(["", "", " and the common end of it all is here for you"])))
    return out


@pytest.mark.parametrize(("tile", "sent"), [(4, 0), (512, nj.PAIRS_SENT)])
def test_near_copies(spark, tile, sent, monkeypatch):
    monkeypatch.setattr(nj, "TILE", tile)
    monkeypatch.setattr(nj, "PAIRS_SENT", sent)
    check(spark, near_copies(150))


def test_whole_table(spark, data_dir):
    check(spark, [(r.doc_id, r.text) for r in table(spark, data_dir, "documents").collect()])


def test_awkward_rows(spark):
    got = nj.join(awkward(spark))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == components([(i, t) for i, t, *_ in rows()])
    assert nj.join(empty(spark)).collect() == []


def test_one_of_each(spark):
    df = awkward(spark)
    left = nj.one_of_each(df)
    assert left.columns == df.columns
    # 2 and 3 are near 1, 9 is a copy of 8; texts without words stay.
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 1, 4, 5, 6, 7, 8, 10, 11, 12, None], key=str)


def test_one_of_each_decides_by_row(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    some = [(1, a), (5, a + " tail"), (5, b), (5, None), (6, c), (6, c + " end"), (None, b + " tail"), (None, prose(4, 60)),
            (None, prose(4, 60) + " end"), (None, " "), (7, "alone"), (7, "other")]
    left = [tuple(r) for r in nj.one_of_each(spark.createDataFrame(some, "doc_id long, text string").repartition(3)).collect()]
    # Either of two near texts with one id, or with none, may be the one that stays.
    assert sorted(map(str, left)) in [sorted(map(str, [(1, a), (5, b), (5, None), (6, x), (None, y), (None, " "), (7, "alone"), (7, "other")]))
                                      for x in (c, c + " end") for y in (prose(4, 60), prose(4, 60) + " end")]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
                                   [(i, j) for i in range(5) for j in range(5)] + [(10, 11), (11, 12), (12, 9)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_sparse_counters_are_small():
    """A task fills a small part of its counters; they take about what tells which ones."""
    rng = np.random.default_rng(1)
    counts = np.zeros(1 << 19, np.uint8)
    nj._add(counts, rng.integers(0, 1 << 19, 42_000, dtype=np.uint32))
    packed = nj._packed(counts)
    assert len(packed) < 45_000 and nj._unpacked(packed).tolist() == counts.tolist()
    for some in (np.zeros(64, np.uint8), np.arange(1 << 12), np.full(8, 2**31 - 1)):
        assert nj._unpacked(nj._packed(some)).tolist() == some.tolist()
    nj._add(counts, np.full(1000, 7, np.uint32))
    assert counts[7] == 255
    codes = nj._coded(np.append(np.arange(200_000), 2**31 - 1))
    assert codes.dtype == np.uint8 and codes[:128].tolist() == list(range(128)) and (np.diff(codes.astype(int)) >= 0).all()


def test_few_columns_are_marked_by_mistake(spark):
    rng = np.random.default_rng(2)
    marked, others = rng.integers(-2**63, 2**63 - 1, 5000), rng.integers(-2**63, 2**63 - 1, 100_000)
    bits = nj._bits(len(marked))
    array = nj.bitmap(spark.createDataFrame([(int(h),) for h in marked], "g long"), "g", bits)
    assert nj.in_bitmap(array, bits, marked).all()
    assert nj.in_bitmap(array, bits, others).mean() < 0.02
    assert nj._bits(10**12) == nj.MOST_BITS


def test_largest_component_of_a_tile_comes_last():
    rng = np.random.default_rng(4)
    root = np.concatenate([rng.integers(0, 4, 30), [9], [5, 5, 6], rng.integers(0, 3, 50)])
    edges = np.array([0, 30, 31, 34, 84])
    order, main = nj._main_last(root, edges)
    assert sorted(order.tolist()) == list(range(84))
    for lo, hi in zip(edges, edges[1:], strict=False):
        own, last = root[order[lo:hi]], main[lo:hi]
        assert sorted(order[lo:hi].tolist()) == list(range(lo, hi)) and (np.diff(last.astype(int)) >= 0).all()
        assert len(set(own[last])) == 1 and last.sum() == np.bincount(own).max() and not set(own[last]) & set(own[~last])
