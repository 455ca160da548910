"""The corpus pipeline: each stage applies one operator to what the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plateflow.llm import bpe, decontamination, language_id, line_dedup, ngram_join, word_bpe
from plateflow.llm.frames import table

TOKENIZER = "word_bpe_49k.json"


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; the classifier learns from the labels among them."""
    return language_id.accept(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats; those left with nothing go."""
    return line_dedup.clean(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the token ids of the whole text and digests of the round trip."""
    tokenizer = word_bpe.read_tokenizer(public_tokenizers.path(TOKENIZER))
    return bpe.round_trip(docs, tokenizer, keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("language ID", in_known_language),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmarks),
    ("BPE encoding and decoding", tokens),
]

#: SQL has no counterpart of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
