from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_frames import awkward, empty, rows

from plateflow.llm.sharding import Permutation, number_at, place_of, shard


@pytest.mark.parametrize("n", [0, 1, 2, 3, 16, 17, 1000, 4097])
def test_permutation_is_one(n):
    p = Permutation(n, seed=5)
    image = p.forward(np.arange(n))
    assert sorted(image.tolist()) == list(range(n))
    assert (p.backward(image) == np.arange(n)).all()


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 10**12), st.integers(0, 2**64 - 1), st.data())
def test_place_and_number_are_inverse(n, seed, data):
    number, shards = data.draw(st.integers(0, n - 1)), data.draw(st.integers(1, 50))
    place = place_of(number, n, shards, seed)
    assert number_at(*place, n, shards, seed) == number


def test_shuffle_moves_rows():
    image = Permutation(10_000).forward(np.arange(10_000))
    assert abs(np.corrcoef(np.arange(10_000), image)[0, 1]) < 0.05
    assert not (Permutation(10_000, 1).forward(np.arange(10_000)) == image).all()


def test_shards_of_awkward_rows(spark):
    out = shard(awkward(spark), 4).collect()
    assert len(out) == len(rows())
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s, count in counts.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(count))
    texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == texts
    assert {r.law for r in out} == {"rows"} and {r.grown_shard for r in out} == {None}
    for r in out:
        assert (r.shard, r.slot) == place_of(r.row_number, len(out), 4)


def test_shards_do_not_depend_on_partitions(spark):
    df = awkward(spark)
    assert sorted(map(str, shard(df.coalesce(1), 5).collect())) == sorted(map(str, shard(df.repartition(7), 5).collect()))


def test_no_rows(spark):
    assert shard(empty(spark)).collect() == []
