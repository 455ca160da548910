from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_frames import awkward, empty, rows, table_of

from plateflow.llm import language_id as lid
from plateflow.llm.frames import table


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = "Stra\u00dfe und Haus, " * 100
    whole = lid.features(text)
    monkeypatch.setattr(lid, "PIECE", 37)
    assert np.allclose(whole, lid.features(text)) and abs(np.linalg.norm(whole) - 1) < 1e-9
    assert lid.features("12 !!") is None and lid.features("") is None and lid.features("\u4e2d") is not None


def test_held_out_accuracy(spark, data_dir):
    docs = table(spark, data_dir, "documents")
    got = lid.identify(docs, keep=["doc_id", "lang"]).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    test = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in test) / len(test) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_documents_teach_nothing(spark, data_dir):
    from pyspark.sql import functions as F

    docs = table(spark, data_dir, "documents")
    wrong = docs.withColumn("lang", F.when(lid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert sorted(map(str, lid.identify(docs).collect())) == sorted(map(str, lid.identify(wrong).collect()))


def test_awkward_rows(spark):
    got = table_of(lid.identify(awkward(spark), keep=["doc_id", "score", "a.b"]))
    assert sum(map(len, got.values())) == len(rows())
    for i in (4, 5, 6, 7):
        assert [(r.lang_pred, r.score) for r in got[i]] == [("und", 0.0)]
    assert got[None][0].held_out is False and got[1][0]["a.b"] == "own a.b"
    learned = {lang for i, _, lang, *_ in rows() if lang and zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r.lang_pred for x in got.values() for r in x} <= learned | {"und"}
    kept = lid.accept(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert set(table_of(kept)) == set(got) - {4, 5, 6, 7}


def test_nothing_to_learn_from(spark):
    assert lid.identify(empty(spark)).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id int, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lid.identify(unlabelled).collect()] == [("und", 0.0)]
    one = spark.createDataFrame([(1, "some text", "qq"), (2, "more", None)], "doc_id int, text string, lang string")
    assert {r.lang_pred for r in lid.identify(one).collect()} == {"qq"}


def test_more_languages_than_sampled_rows(spark):
    words = {"aa": "kala maja", "bb": "sturm und drang", "cc": "zwyx qvut", "dd": "fjord hygge", "ee": "pueblo ojo"}
    docs = [(i, words[lang] + " " + words[lang], lang) for i in range(60) for lang in [sorted(words)[i % 5]]]
    # Letters may be rare among the rows of a language.
    docs += [(100 + i, "12 34", "ff") for i in range(60)] + [(400, "\u4e2d\u6587", "ff"), (401, "\u4e2d\u6587", "ff")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = lid.identify(df, keep=["doc_id", "lang"], sample_rows=3).filter("score > 0").collect()
    assert len(got) == 62 and all(r.lang == r.lang_pred for r in got)


@pytest.mark.parametrize("languages", [("aa", "bb"), ("en", "de", "nl", "fr", "aa")])
def test_hierarchy(languages):
    rng = np.random.default_rng(1)
    x = np.abs(np.repeat(np.eye(len(languages), 40), 30, axis=0) + 0.1 * rng.random((30 * len(languages), 40)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    names = [name for name in languages for _ in range(30)]
    model = lid.fit(x.astype(np.float32), names)
    assert [model.predict(v)[0] for v in x] == names
    assert model.families == tuple(sorted({lid.FAMILY_OF.get(n, n) for n in languages}))
