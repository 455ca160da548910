"""DuckDB SQL of resampling and the Merkle manifest."""

from __future__ import annotations

#: Checksums byte by byte over a table built from the polynomial.
_CRC = """
bits(i, k, c) as (
  select range, 0, range::bigint from range(256)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
crc_table as (select list(c order by i) as tab from bits where k = 8)"""


def _crc(column: str) -> str:
    """crc32 of the UTF-8 bytes of a column."""
    data = f"list_transform(range(length(hex({column})) // 2), lambda i: ('0x' || substr(hex({column}), 2 * i + 1, 2))::bigint)"
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, {data}),"
            " lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

RESAMPLING = f"""
with recursive {_CRC},
docs as (select row_number() over () as r, doc_id, text from documents),
every as (
  select r, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w from docs),
aimed as (
  select unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w from benchmark),
places as (
  select w, {_crc('w')} % 10000 as bucket from (select w from every union select w from aimed), crc_table),
s as (select bucket, count(*) as n from every join places using (w) group by bucket),
t as (select bucket, count(*) as n from aimed join places using (w) group by bucket),
totals as (select (select coalesce(sum(n), 0) from s)::double as s, (select coalesce(sum(n), 0) from t)::double as t),
gains as (
  select b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (totals.s + 10000)
    / ((coalesce(s.n, 0) + 1)::double * (totals.t + 10000))))::bigint as gain
  from (select distinct bucket from places) b left join s using (bucket) left join t using (bucket), totals),
means as (
  select r, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
  from every join places using (w) join gains using (bucket) group by r),
scored as (
  select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint + 0.5::double)
      / 4294967296)))::bigint as score
  from docs left join means using (r)),
ranked as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
    count(*) over (partition by n_features >= 20) as able
  from scored)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= 10 * able // 100 then place end as rank
from ranked
"""

def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({x}::varchar)::varchar || ':' || {x}::varchar, '-')"
             for x in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


#: The nodes of a run with one of them replaced.
_RUN = "array_to_string(b.nodes[:(a.no % 8)], '') || {} || array_to_string(b.nodes[(a.no % 8 + 2):], '')"
MERKLE = f"""
with recursive {_CRC},
leaves as (
  select doc_id, lang, {_leaf('text')} as leaf,
    case when {_crc('doc_id::varchar')} % 3 = 0 then {_leaf(f"translate(text, {_LOWER})")} else {_leaf('text')} end as held
  from documents, crc_table),
numbered as (
  select *, row_number() over (partition by lang order by doc_id, leaf) - 1 as no, count(*) over (partition by lang) as n
  from leaves),
tree(lang, level, no, n, node) as (
  select lang, 0, no, n, leaf from numbered
  union all
  select lang, level + 1, no // 8, any_value((n + 7) // 8), sha256(string_agg(node, '' order by no))
  from tree where n > 1 group by lang, level, no // 8),
subroots as (
  select lang, node, row_number() over (order by lang nulls first) - 1 as no, count(*) over () as n from tree where n = 1),
upper(level, no, n, node) as (
  select 0, no, n, node from subroots
  union all
  select level + 1, no // 8, any_value((n + 7) // 8), sha256(string_agg(node, '' order by no))
  from upper where n > 1 group by level, no // 8),
runs as (
  select lang, level, no // 8 as run, list(node order by no) as nodes from tree where n > 1 group by lang, level, no // 8),
upper_runs as (select level, no // 8 as run, list(node order by no) as nodes from upper where n > 1 group by level, no // 8),
walk(doc_id, place, lang, level, no, node, proof, done) as (
  select doc_id, no, lang, 0, no, held, '', false from numbered
  union all
  select a.doc_id, a.place, a.lang, a.level + 1, a.no // 8,
    case when b.run is null then a.node else sha256({_RUN.format('a.node')}) end,
    case when b.run is null then a.proof else a.proof || {_RUN.format("''")} end, b.run is null
  from walk a left join runs b on a.lang is not distinct from b.lang and a.level = b.level and a.no // 8 = b.run
  where not a.done),
climb(doc_id, place, lang, level, no, node, proof, done) as (
  select w.doc_id, w.place, w.lang, 0, s.no, w.node, w.proof, false
  from walk w join subroots s on w.lang is not distinct from s.lang where w.done
  union all
  select a.doc_id, a.place, a.lang, a.level + 1, a.no // 8,
    case when b.run is null then a.node else sha256({_RUN.format('a.node')}) end,
    case when b.run is null then a.proof else a.proof || {_RUN.format("''")} end, b.run is null
  from climb a left join upper_runs b on a.level = b.level and a.no // 8 = b.run
  where not a.done),
root as (select node as root from upper where n = 1)
select c.doc_id, l.leaf, s.node as subroot, root, sha256(c.proof) as proof_sha256, c.node as folded_root, c.node = root as verified
from climb c join numbered l on c.place = l.no and c.lang is not distinct from l.lang
join subroots s on c.lang is not distinct from s.lang, root
where c.done
"""
