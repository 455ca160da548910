from __future__ import annotations

import sys

import corpus_pipeline
import duckdb
import pytest
from llm_frames import DOCS, awkward, prose, rows
from test_llm_decontamination import expected as contaminated
from test_llm_line_dedup import expected as deduped
from test_llm_ngram_join import components

from plateflow.llm import queries


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A corpus whose result is known from brute force."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    base = prose(41, 90)
    near = base.split()
    near[40] = "changedentirely"
    docs = [(k, prose(50 + k, 40) + "\n" + prose(70 + k, 30), "en" if k % 2 else "de", "s", 1) for k in range(20)]
    docs += [(30, base, "en", "s", 1), (31, base, "en", "s", 1), (32, " ".join(near), "en", "s", 1), (33, None, None, None, None),
             (34, "12 34", "en", "s", 1), (35, prose(99, 20) + " " + prose(98, 20), "de", "s", 1), (36, prose(50, 40), "en", "s", 1)]
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, prose(99, 20))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs


def test_result_by_brute_force(spark, small):
    folder, docs = small
    left = [(i, t) for i, t, *_ in docs if t and any(c.isalpha() for c in t)]
    lines = deduped(left)
    left = [(i, lines[i][0]) for i, _ in left if lines[i][0].strip() or lines[i][3] + lines[i][4] == 0]
    group = {i: c for i, _, c in components(left)}
    left = [(i, t) for i, t in left if group[i] == i]
    left = [(i, t) for i, t in left if not contaminated(t, [("1", prose(99, 20))])[4]]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(got) == sorted(i for i, _ in left)
    assert not {31, 32, 33, 34, 35, 36} & set(got) and {30, 0} <= set(got)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.public_tokenizers.path(queries.TOKENIZER))
    for i, text in left:
        assert got[i].ids == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("at", range(4))
def test_stages_return_the_columns_of_documents(spark, small, at):
    docs = awkward(spark)
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, docs, small[0])
    assert out.columns == docs.columns and out.count() > 0, name
    assert stage(spark, docs.limit(0), small[0]).collect() == []


def test_last_stage(spark, small):
    assert corpus_pipeline.STAGES[-1][1](spark, awkward(spark), small[0]).count() == len(rows())


@pytest.mark.parametrize("name", queries.ORACLE)
def test_queries_against_sql(spark, data_dir, name):
    got = queries.QUERIES[name](spark, data_dir)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{data_dir}/{t}.parquet')")
    wanted = con.execute(queries.ORACLE[name])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, wanted.fetchall())) == sorted(str(tuple(r)) for r in got.select(*names).collect())


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE])
def test_every_query_runs_over_its_whole_table(spark, data_dir, name):
    table = "pages" if name == "op10_warc" else "documents"
    rows = spark.read.parquet(f"{data_dir}/{table}.parquet").count()
    assert queries.QUERIES[name](spark, data_dir).count() == rows * (2 if name == "op10_warc" else 1)


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {*queries.QUERIES, "pipeline"} <= set(names)
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert "corpus_pipeline" in sys.modules
