from __future__ import annotations

import hashlib
import re

import pytest
from llm_frames import awkward, empty, prose, rows
from pyspark.sql import functions as F

from plateflow.llm import decontamination as dc
from plateflow.llm.frames import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(text, items):
    words = WORD.findall(lower(text))
    spots = [m.span() for m in WORD.finditer(lower(text))]
    hit, found = set(), set()
    for name, item in items:
        have = WORD.findall(lower(item))
        size = min(13, len(have))
        for k in range(len(have) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at:at + size] == have[k:k + size]:
                    hit.update(range(at, at + size))
                    found.add(name)
    spans, run = [], None
    for k in sorted(hit):
        if run and run[1] == k:
            run[1] = k + 1
        else:
            run = [k, k + 1]
            spans.append(run)
    spans = [(spots[a][0], spots[b - 1][1]) for a, b in spans]
    return len(words), len(hit), sorted(found), spans, len(hit) > 0 and 20 * len(hit) >= len(words)


ITEMS = [("7", prose(21, 30)), ("10", "Two words!"), ("3", None), ("x", "..."), ("8", prose(22, 13)), ("7", prose(23, 14)), ("", "caf\u00e9 \u4e2d\u6587 7")]


def documents():
    whole = prose(21, 30).split()
    return [
        "start, " + " -- ".join(whole[3:20]) + " end", "TWO\u2003words two  WORDS", "two words", " ".join(whole[:12]),
        prose(30, 400) + " " + prose(22, 13) + " " + prose(31, 30), prose(23, 14).upper() + " caf\u00c9 \u4e2d\u6587 7. caf\u00e9 \u4e2d\u6587 7",
        "\U0001f600 caf\u00e9 \u4e2d\u6587 7!", "", None, "...", prose(21, 30) + " " + prose(21, 30)]


@pytest.mark.parametrize(("automaton", "piece"), [(1 << 18, 1 << 24), (60, 1 << 24), (1 << 18, 40), (60, 40)])
def test_against_all_windows(spark, automaton, piece):
    docs = spark.createDataFrame(list(enumerate(documents())), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = dc.find_contamination(docs, items, keep=["doc_id", "text"], automaton_bytes=automaton, pass_bytes=piece).collect()
    assert len(got) == len(documents())
    clean = [(name, text) for name, text in ITEMS]
    for r in got:
        wanted = expected(r.text, clean)
        assert (r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans], r.contaminated) == wanted, r.text


def test_passes_hold_one_part_of_the_items(spark, monkeypatch):
    parts, given = [], dc._pass

    def one_pass(items, *rest):
        # Parts before this one are in the scratch folder by now, not in the plan.
        parts.append(list(items))
        return given(items, *rest)

    plans, appended = [], dc.append
    monkeypatch.setattr(dc, "_pass", one_pass)
    monkeypatch.setattr(dc, "append", lambda df, *a, **k: plans.append(df._jdf.queryExecution().logical().toString()) or appended(df, *a, **k))
    docs = spark.createDataFrame(list(enumerate(documents())), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS + [ITEMS[0]] * 50, "item_id string, text string")
    got = dc.find_contamination(docs, items, keep=["doc_id", "text"], pass_bytes=200).collect()
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == expected(r.text, ITEMS)[:3]
    assert len(parts) > 1 and not any("MapInArrow" in p for p in plans)
    # Items that repeat are one, and count once for the number of passes.
    assert sum(map(len, parts)) == len(set(ITEMS)) - 1 and len(parts) <= 3


def test_spans_are_of_the_text_as_it_was(spark):
    text = "\U0001f600 \u00e9t\u00e9: Two,  WORDS; end"
    row = dc.find_contamination(spark.createDataFrame([(1, text)], "doc_id int, text string"),
                                spark.createDataFrame(ITEMS, "item_id string, text string")).first()
    assert [text[s.first:s.last] for s in row.spans] == ["Two,  WORDS"]


def test_whole_table(spark, data_dir):
    docs, items = table(spark, data_dir, "documents"), table(spark, data_dir, "benchmark")
    known = [(str(r.item_id), r.text) for r in items.collect()]
    index = {}
    for name, text in known:
        words = WORD.findall(lower(text))
        for k in range(max(1, len(words) - 12)):
            index.setdefault(tuple(words[k:k + 13]), set()).add(name)
    got = {r.doc_id: r for r in dc.digest(dc.find_contamination(docs, items)).collect()}
    for r in docs.collect():
        words, hit, found = WORD.findall(lower(r.text)), set(), set()
        for size in {len(w) for w in index}:
            for at in range(len(words) - size + 1):
                if names := index.get(tuple(words[at:at + size])):
                    hit.update(range(at, at + size))
                    found |= names
        x = got[r.doc_id]
        wanted = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (x.n_words, x.n_hit, x.n_items, x.items_sha256) == (len(words), len(hit), len(found), wanted)
        assert x.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))


def test_awkward_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = dc.find_contamination(awkward(spark), items, keep=["doc_id", "text", "items", "_hit_words"], pass_bytes=50).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_words, r.n_hit) == expected(r.text, ITEMS)[:2] if len(r.text or "") < 9999 else r.n_words > 9999
        assert r["_hit_words"] == "own _hit_words"
    assert dc.find_contamination(empty(spark), items).collect() == []
    none = dc.find_contamination(awkward(spark), items.limit(0))
    assert none.filter("n_hit > 0 or contaminated").count() == 0


def test_clean(spark):
    df = awkward(spark)
    items = spark.createDataFrame([(1, "one two"), (None, "34")], "item_id int, text string")
    left = dc.clean(df, items)
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((i for i, *_ in rows() if i not in (7, 8, 9)), key=str)
    assert left.select(F.max("items")).first()[0] == "own items"
