from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from llm_frames import DOCS, awkward, empty, rows

from plateflow.llm.frames import table
from plateflow.llm.merkle import fold, manifest, reduce, siblings

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        start = at // 8 * 8
        out.append(("".join(level[start:at]), "".join(level[at + 1:start + 8])))
        at //= 8
    return out


def brute(docs):
    groups = defaultdict(list)
    for d in docs:
        groups[d[2]].append((d[0] is not None, d[0] or 0, leaf(*d), d))
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for key in order:
        groups[key].sort(key=lambda x: x[:3])
        trees[key] = tree([x[2] for x in groups[key]])
    top = tree([trees[key][-1][0] for key in order])
    out = Counter()
    for j, key in enumerate(order):
        for i, (_, _, node, d) in enumerate(groups[key]):
            steps = path(trees[key], i) + path(top, j)
            changed = d
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[1] is not None:
                changed = (d[0], d[1].translate(LOWER), *d[2:])
            folded = leaf(*changed)
            for before, after in steps:
                folded = h(before + folded + after)
            root = top[-1][0]
            out[(d[0], node, trees[key][-1][0], root, h("".join(b + a for b, a in steps)), folded, folded == root)] += 1
    return out


def result(df):
    assert [c for c, _ in df.dtypes] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in df.collect())


def test_local_pieces():
    for n in (1, 2, 8, 9, 64, 65, 100):
        nodes = [h(str(i)) for i in range(n)]
        levels, top, left = reduce(nodes, n, 9)
        assert left == 1 and top == tree(nodes)[-1][0]
        assert all(fold(node, *siblings(levels, i)) == top for i, node in enumerate(nodes))
    # The last superblock of a larger group: its only node is hashed once on every level.
    assert reduce(["a"], 65, 2)[1:] == (h(h("a")), 2)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert result(manifest(docs)) == brute(rows())
    assert manifest(empty(spark)).collect() == []
    one = spark.createDataFrame(rows()[:1], DOCS)
    found = manifest(one).collect()
    assert len(found) == 1 and found[0].leaf == found[0].subroot == found[0].root and found[0].proof_sha256 == h("")
    assert found[0].verified == (found[0].folded_root == found[0].root)


@pytest.mark.parametrize("levels", [1, 2])
def test_many_groups_and_superblocks(spark, levels):
    """A hot group over many superblocks, more groups than one run holds, large ids beside nulls, repeats."""
    docs = [(2**60 + i if i % 50 else None, f"Text {i % 40}", "hot", "s", i % 40) for i in range(300)]
    docs += [(i, f"T{i}", f"lang{i % 75}" if i % 11 else None, None, i) for i in range(200)]
    docs += docs[:20] + [(7, "é Z", "", "", None), (8, None, "\U0001f600", "x", 1)]
    got = manifest(spark.createDataFrame(docs, DOCS).repartition(7), levels=levels)
    assert result(got) == brute(docs)


def test_whole_table(spark, data_dir):
    docs = table(spark, data_dir, "documents")
    want = brute([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()])
    got = result(manifest(docs))
    assert got == want
    assert {r[6] for r in got} == {True, False}
