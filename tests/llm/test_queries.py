"""The registered queries: names, SQL oracles on a small table, the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from tremorlake.llm.queries import ORACLE, QUERIES

from .odd import odd_docs

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    want = sorted((tuple(r[rel.columns.index(c)] for c in got.columns) for r in rel.fetchall()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want and want


def test_pipeline_keeps_columns_and_shrinks(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        n = docs.count()
        assert 0 < n <= before, name
        before = n
        assert docs.columns == columns or name == "byte_bpe"
    assert docs.columns == ["doc_id", "n_tokens", "ids"] and docs.filter("length(ids) <> 4 * n_tokens").count() == 0


def test_pipeline_stages_bear_no_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


@pytest.mark.parametrize("name", ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination"])
def test_stages_bear_reserved_names_and_odd_rows(spark, name):
    docs = odd_docs(spark)
    got = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r["__score"] for r in rows} <= {"clash"} and {r["kept_0"] for r in rows} <= {"clash"}


def test_pipeline_decodes_what_it_encodes(spark, monkeypatch):
    """A pattern that leaves characters out gives ids that are not the text's; only decoding shows it."""
    docs = spark.createDataFrame([(1, "abc"), (2, "abc 12"), (3, None)], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["byte_bpe"]
    assert stage(spark, docs, SF).count() == 3
    monkeypatch.setattr(corpus_pipeline.public_tokenizers, "PATTERN", "[a-z]+")
    with pytest.raises(Exception, match="document 2 do not decode"):
        stage(spark, docs, SF).collect()
