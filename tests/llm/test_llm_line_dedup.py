from __future__ import annotations

import random

import pytest
from llm_frames import awkward, empty, rows
from pyspark.sql import functions as F

from plateflow.llm import line_dedup as ld
from plateflow.llm.frames import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def expected(docs):
    """{doc_id: (text, n_lines, n_kept, n_exact, n_near)} by comparing every line with all before it."""
    order = sorted(((i is not None, i or 0), t) for i, t in set(docs) if t is not None)
    earlier, out = {}, {}
    places = [(key, no, line) for key, text in order for no, line in enumerate(text.split("\n"))]
    first = {}
    for key, no, line in places:
        if line.strip(" "):
            first.setdefault(line, (key, no))
    late = set()
    lines = sorted(first, key=first.get)
    for n, line in enumerate(lines):
        for other in lines[:n]:
            most = min(2, min(len(line), len(other)) // 12)
            if abs(len(line) - len(other)) <= most and distance(line, other) <= most:
                late.add(line)
                break
    del earlier
    for key, text in order:
        kept, exact, near = [], 0, 0
        for no, line in enumerate(text.split("\n")):
            if line.strip(" ") and first[line] != (key, no):
                exact += 1
            elif line in late:
                near += 1
            else:
                kept.append(line)
        out[key[1] if key[0] else None] = ("\n".join(kept), len(text.split("\n")), len(kept), exact, near)
    return out


def result(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_kept, r.n_exact, r.n_near) for r in df.collect() if r.text is not None}


def noisy(n, seed=3):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcde \u00e9") for _ in range(rng.choice([3, 11, 12, 15, 23, 24, 31, 33, 60, 140]))) for _ in range(40)]
    out = []
    for k in range(n):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                p = rng.randrange(len(line) + 1)
                line[p:p + rng.choice([0, 1])] = rng.choice(["", "x", "yz"])
            lines.append("".join(line))
        out.append((n - k, "\n".join(lines)))
    return out


@pytest.mark.parametrize(("seed", "crowd"), [(1, ld.CROWD), (2, 2), (3, 0)])
def test_against_all_pairs(spark, seed, crowd, monkeypatch):
    monkeypatch.setattr(ld, "CROWD", crowd)
    docs = noisy(90, seed)
    got = result(ld.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)))
    assert got == expected(docs)


def test_distance(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice("ab\u00e9") for _ in range(rng.randint(0, 40)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            p = rng.randrange(len(b) + 1)
            b[p:p + rng.choice([0, 1])] = rng.choice(["", "a", "c"])
        pairs.append(tuple(sorted((a, "".join(b)), key=len, reverse=True)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for most in (1, 2, 3):
        got = df.select("a", "b", ld.edit_distance(F.col("a"), F.col("b"), most).alias("d")).collect()
        assert all(min(r.d, most + 1) == min(distance(r.a, r.b), most + 1) for r in got)


def test_awkward_rows(spark):
    df = awkward(spark)
    out = ld.dedup(df, keep=["doc_id", "near", "n_lines", "a.b"])
    assert out.count() == len(rows()) and out.columns == ["doc_id", "near", "a.b", "text", "n_lines", "n_kept", "n_exact", "n_near"]
    wanted = expected([(i, t) for i, t, *_ in rows()])
    assert result(out) == wanted
    assert [tuple(r)[3:] for r in out.filter("doc_id = 4").collect()] == [(None, 0, 0, 0, 0)]
    # Rows that share doc_id and line are one.
    assert [r.n_kept for r in out.filter("doc_id = 1").collect()] == [1, 1]
    assert ld.dedup(empty(spark)).collect() == []


def test_clean(spark):
    df = awkward(spark)
    left = ld.clean(df)
    assert left.columns == df.columns and left.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    ids = [r.doc_id for r in left.collect()]
    assert 2 not in ids and 9 not in ids and {4, 5, 6, 8}.issubset(ids) and ids.count(1) == 2
    row = left.filter("doc_id = 11").first()
    assert row.n_chars == len(row.text) and row.near == "own near"


def test_no_python_on_the_path(spark, data_dir):
    plan = ld.dedup(table(spark, data_dir, "documents"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
