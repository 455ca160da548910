from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from llm_frames import CLASHES, awkward, empty, rows

from plateflow.llm.frames import table
from plateflow.llm.piece_bpe import PieceModel, decode, encode, read_model, round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return read_model(PATH)


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def wanted(text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def ids_of(pieces, text):
    return [pieces.begin, *(i for s in pieces.stretches(text) for i in pieces.encode(s)), pieces.end]


TEXTS = ["", " ", "   ", "  a  b ", "a\nb\tc\r\n", "x\0y", "<s> </s> <0x0A> <unk>", "▁a ▁▁", "é́ﬁ①　x​�", "한국어 🙂🙂 \U0010ffff",
         "a" * 999, " " * 999, "ab" * 777, "中文字" * 300, "the" * 500, "1" * 400, "\n" * 50 + " \n" * 50]


def test_ids_are_those_of_the_library(model):
    pieces = model.load()
    for text in TEXTS:
        ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
        assert ids_of(pieces, text) == ids, repr(text[:40])
        assert pieces.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("ab the\n ▁é🙂1ing", max_size=60))
def test_any_text(text):
    pieces = read_model(PATH).load()
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert ids_of(pieces, text) == ids and pieces.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 31_999), max_size=12))
def test_any_ids_decode(ids):
    assert read_model(PATH).load().decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(259, 31_999), min_size=1, max_size=6))
def test_backtracking_equals_merging(ids):
    """Tokens side by side, most of which are not what the text is encoded to."""
    pieces = read_model(PATH).load()
    text = "".join(pieces.token_of[i] for i in ids)
    assert pieces.tokens(text) == pieces.merge(text)


def test_other_kinds_of_model_are_refused():
    with pytest.raises(ValueError):
        PieceModel(b"").load()


def test_awkward_rows(spark, model):
    got = round_trip(awkward(spark), model, keep=["doc_id", "text", *CLASHES]).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == wanted(r.text)
        assert r.ids == "own ids" and r["a.b"] == "own a.b"
    assert round_trip(empty(spark), model, keep=["doc_id"]).collect() == []


def test_encode_and_decode(spark, model):
    encoded = encode(awkward(spark), model, keep=["doc_id", "text"])
    for r in decode(encoded, model, keep=["doc_id", "text", "ids"]).collect():
        assert r.ids == LIBRARY.encode(r.text or "", add_bos=True, add_eos=True) and r.decoded == LIBRARY.decode(r.ids)
    bare = encode(awkward(spark), model, keep=["text"], begin=False, end=False).collect()
    assert all(r.ids == LIBRARY.encode(r.text or "") for r in bare)
    odd = spark.createDataFrame([(1, [0, 10**6, 5000, None]), (2, None), (3, [])], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in decode(odd, model, keep=["doc_id"]).collect()} == {
        1: LIBRARY.decode([0, 5000]), 2: "", 3: ""}


def test_whole_table(spark, data_dir, model):
    docs = table(spark, data_dir, "documents")
    got = round_trip(docs, model, keep=["doc_id", "text"]).collect()
    assert len(got) == docs.count()
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == wanted(r.text) for r in got)
