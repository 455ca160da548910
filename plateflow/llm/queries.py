"""Registered queries of the text operators, with DuckDB SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plateflow.llm import (bpe, decontamination, fingerprints, language_id, line_dedup, merkle, ngram_join, piece_bpe,
                           resampling, sharding, token_counts, url_filters, warc, word_bpe)
from plateflow.llm.frames import table
from plateflow.llm.oracle import MERKLE, RESAMPLING

SHARDS = 16
TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
#: The pages have no time of capture; their records carry this one.
CAPTURED = "2001-01-01T00:00:00Z"


def op1_sharding(spark: SparkSession, directory: str) -> DataFrame:
    return sharding.shard(table(spark, directory, "documents"), SHARDS)


def op2_url_filters(spark: SparkSession, directory: str) -> DataFrame:
    return url_filters.judge(table(spark, directory, "pages"))


def op3_ngram_join(spark: SparkSession, directory: str) -> DataFrame:
    return ngram_join.join(table(spark, directory, "documents"))


def op4_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return line_dedup.dedup(table(spark, directory, "documents"))


def op5_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, directory, "documents"))


def op6_language_id(spark: SparkSession, directory: str) -> DataFrame:
    return language_id.identify(table(spark, directory, "documents"))


def op7_bpe(spark: SparkSession, directory: str) -> DataFrame:
    tokenizer = word_bpe.read_tokenizer(public_tokenizers.path(TOKENIZER))
    return bpe.round_trip(table(spark, directory, "documents"), tokenizer, keep=["doc_id"])


def op8_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontamination.digest(decontamination.find_contamination(
        table(spark, directory, "documents"), table(spark, directory, "benchmark")))


def op9_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    tokenizer = word_bpe.read_tokenizer(public_tokenizers.path(TOKENIZER))
    return token_counts.count_tokens(table(spark, directory, "documents"), tokenizer, keep=["doc_id"])


def op10_warc(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages")
    records = warc.derive(warc.responses(pages, CAPTURED), keep=["page_id"])
    return warc.flatten(records, keep=["page_id"])


def op11_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    model = piece_bpe.read_model(public_tokenizers.path(PIECES))
    return piece_bpe.round_trip(table(spark, directory, "documents"), model, keep=["doc_id"])


def op12_resampling(spark: SparkSession, directory: str) -> DataFrame:
    return resampling.resample(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    return merkle.manifest(table(spark, directory, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_url_filters": op2_url_filters,
    "op3_ngram_join": op3_ngram_join,
    "op4_line_dedup": op4_line_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_language_id": op6_language_id,
    "op7_bpe": op7_bpe,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_warc": op10_warc,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_resampling": op12_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: levenshtein counts bytes in DuckDB, so the test data's letters beyond ASCII become one byte each.
_LETTERS = "ßàáâäçèéêíîñóöúûüÄÇÈÉÊÍÑÓÖÜ"
_SPARE = (*range(1, 9), 11, 12, *range(14, 32))
_ONE_BYTE = " || ".join(f"chr({i})" for i in _SPARE[:len(_LETTERS)])
_COUNTS = ", ".join(f"length(line) - length(replace(line, '{c}', '')) as n{i}" for i, c in enumerate(" entirsaohl"))
_APART = " + ".join(f"abs(a.n{i} - b.n{i})" for i in range(11))

ORACLE: dict[str, str] = {
    "op4_line_dedup": f"""
with every as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
    unnest(range(len(string_split(text, chr(10))))) as no
  from documents),
lines as (
  select line, length(line) as n, min(doc_id * 1000000000 + no) as first, {_COUNTS}
  from every where trim(line) <> '' group by line),
near as (
  select greatest(a.first, b.first) as late
  from (select *, unnest([n, n - 1, n - 2]) as m from lines where n >= 12) a
  join lines b on b.n = a.m and b.n >= 12 and a.line <> b.line and {_APART} <= 4
  where levenshtein(translate(a.line, '{_LETTERS}', {_ONE_BYTE}), translate(b.line, '{_LETTERS}', {_ONE_BYTE}))
    <= least(2, b.n // 12)),
state as (select line, first, first in (select late from near) as late from lines),
marked as (
  select e.doc_id, e.no, e.line, coalesce(e.doc_id * 1000000000 + e.no <> s.first, false) as repeated,
    coalesce(s.late, false) as late
  from every e left join state s on e.line = s.line)
select doc_id,
  coalesce(string_agg(line, chr(10) order by no) filter (not repeated and not late), '') as text,
  count(*) as n_lines, count(*) filter (not repeated and not late) as n_kept,
  count(*) filter (repeated) as n_exact, count(*) filter (late and not repeated) as n_near
from marked group by doc_id
""",
    "op2_url_filters": """
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
split as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts),
rules(rule, rule_host, rule_path, rule_verdict) as (values
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits as (
  select s.*, r.rule, r.rule_verdict,
    row_number() over (partition by s.n order by length(r.rule) desc nulls last) as place
  from (select *, row_number() over () as n from split) s
  left join rules r on (s.host = r.rule_host or ends_with(s.host, '.' || r.rule_host))
    and starts_with(s.path, r.rule_path))
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict from fits where place = 1
""",
    "op12_resampling": RESAMPLING,
    "op13_merkle_manifest": MERKLE,
}
