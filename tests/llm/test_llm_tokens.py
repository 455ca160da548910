from __future__ import annotations

import hashlib
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from llm_frames import CLASHES, awkward, empty, rows
from tokenizers import Tokenizer

from plateflow.llm.bpe import Batch, decode, encode, merge_words, round_trip
from plateflow.llm.frames import table
from plateflow.llm.token_counts import count_tokens, whole_tokens
from plateflow.llm.word_bpe import read_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return read_tokenizer(PATH)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


TEXTS = ["", " ", "Hello  World", "don't DON'T 'S", "aaaa aaaaaaa aaa", "<|startoftext|>a<|endoftext|>", "x<|endoftext|><|endoftext|> <|END|>",
         "<|endoftext|", "\u03a3\u03bf\u03c6\u03cc\u03c2 \u039f\u0394\u039f\u03a3", "\u0130stanbul", "e\u0301 \u00e9", "123 4\u00bd \u0664", "\u200b\ufeff\x00\x1c\x85a",
         "e<|endoftext|>\u0301x", "\U0001f468\u200d\U0001f469 \u4e2d\u6587", "a\r\n\tb" * 50]


def test_ids_are_those_of_the_library(tokenizer, library):
    batch = Batch(tokenizer.load(), pa.array(TEXTS))
    for text, row in zip(TEXTS, batch.rows, strict=True):
        assert batch.encoded(row).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x2FFF, categories=("L", "N", "P", "S", "Z", "M")), max_size=40), max_size=12))
def test_any_text(texts):
    library, vocabulary = Tokenizer.from_file(PATH), read_tokenizer(PATH).load()
    batch = Batch(vocabulary, pa.array(texts, pa.string()))
    from unicodedata import category

    for text, row in zip(texts, batch.rows, strict=True):
        # Code points that this Python's Unicode does not know may be classed differently.
        if all(category(c) != "Cn" for c in text):
            assert batch.encoded(row).tolist() == library.encode(text, add_special_tokens=False).ids


def test_whole_tokens_are_proved(tokenizer, library):
    words = whole_tokens(tokenizer)
    assert len(words) > 30_000
    for word in words[::97]:
        vocabulary = tokenizer.load()
        if vocabulary.words(word) == [word]:
            assert len(library.encode(word, add_special_tokens=False).ids) == 1
    assert merge_words(tokenizer.load(), [])[0].tolist() == []


def test_round_trip_of_awkward_rows(spark, tokenizer, library):
    got = round_trip(awkward(spark), tokenizer, keep=["doc_id", "text", "ids", "a.b", "n_tokens"]).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, r.text)
        assert r.ids == "own ids" and r["a.b"] == "own a.b"
    assert round_trip(empty(spark), tokenizer, keep=["doc_id"]).collect() == []


def test_encode_and_decode(spark, tokenizer, library):
    back = decode(encode(awkward(spark), tokenizer, keep=["doc_id", "text"]), tokenizer, keep=["doc_id", "text", "ids"]).collect()
    for r in back:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    odd = spark.createDataFrame([(1, [49407, 10**6, 0]), (2, None), (3, [])], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in decode(odd, tokenizer, keep=["doc_id"]).collect()} == {
        1: library.decode([49407, 0], skip_special_tokens=False), 2: "", 3: ""}


def test_counts_of_awkward_rows(spark, tokenizer, library):
    got = count_tokens(awkward(spark), tokenizer, limit=20, keep=["doc_id", "text", *CLASHES]).collect()
    assert len(got) == len(rows())
    for r in got:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 20)
    assert count_tokens(empty(spark), tokenizer, keep=["doc_id"]).collect() == []


def test_whole_table_against_the_library(spark, data_dir, tokenizer, library):
    docs = table(spark, data_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts = {r.doc_id: r for r in count_tokens(docs, tokenizer, keep=["doc_id"]).collect()}
    trips = {r.doc_id: r for r in round_trip(docs, tokenizer, keep=["doc_id"]).collect()}
    assert counts.keys() == trips.keys() == texts.keys()
    for i, text in texts.items():
        wanted = digests(library, text)
        assert (trips[i].n_tokens, trips[i].ids_sha256, trips[i].decoded_sha256) == wanted
        assert counts[i].n_tokens == wanted[0]


def test_every_code_point_is_split_and_cased_as_by_the_library(tokenizer, library):
    """Each code point behind a letter and before a digit, and between signs."""
    vocabulary = tokenizer.load()
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for start in range(0, len(points), 100_000):
        some = [f"a{chr(c)}1 !{chr(c)}!" for c in points[start:start + 100_000]]
        batch = Batch(vocabulary, pa.array(some))
        for text, row, known in zip(some, batch.rows, library.encode_batch(some, add_special_tokens=False), strict=True):
            assert batch.encoded(row).tolist() == known.ids, hex(ord(text[1]))


def test_memory_of_a_batch_is_bounded(tokenizer):
    """Of symbols and links a pre-token takes little, and a batch has no more text than the bound, but one text at least."""
    from plateflow.llm.bpe import BYTES_AT_ONCE
    from plateflow.llm.frames import ROWS_AT_ONCE, pieces

    rng, vocabulary = random.Random(3), tokenizer.load()
    words = ["".join(rng.choices("etaoinshr", k=9)) for _ in range(60_000)]
    merge_words(vocabulary, words[:10])
    tracemalloc.start()
    merge_words(vocabulary, words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * sum(map(len, words))

    texts = ["x" * 3000] * 5000 + [None, "y" * (3 * BYTES_AT_ONCE), "", "z"] + ["short"] * 5000
    cut = list(pieces(pa.array(texts), BYTES_AT_ONCE))
    assert [s for s, _ in cut] == [sum(n for _, n in cut[:i]) for i in range(len(cut))] and sum(n for _, n in cut) == len(texts)
    for start, n in cut:
        assert 1 <= n <= ROWS_AT_ONCE
        assert n == 1 or sum(len(t or "") for t in texts[start:start + n]) <= BYTES_AT_ONCE
    assert len(cut) < 25


def test_texts_around_the_bound(spark, tokenizer, library, monkeypatch):
    monkeypatch.setattr("plateflow.llm.bpe.BYTES_AT_ONCE", 50)
    for r in round_trip(awkward(spark), tokenizer, keep=["doc_id", "text"]).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, r.text)
