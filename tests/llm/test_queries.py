"""Registered queries against their SQL, and the pipeline against its stages in plain form."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from ebbflow.llm import compression_rules, line_crf, simhash_tiles, template_windows
from ebbflow.llm.catalog import ORACLE, REGISTRY
from ebbflow.sources.tables import TABLES
from tools.oracle_check import digest

from conftest import SF_SMALL


def test_one_query_for_each_operator():
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{k}" for k in range(1, 14)}
    assert set(REGISTRY) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = REGISTRY[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = c.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, rows)[0] == digest(names, cur.fetchall())[0]


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLE) - {"op12_balanced_lists"}))
def test_query_runs_over_the_whole_table(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = REGISTRY[name](spark, SF_SMALL)
    ids = {r.doc_id for r in got.select("doc_id").distinct().collect()}
    everything = {r.doc_id for r in docs.select("doc_id").collect()}
    assert ids < everything if name.startswith("op2_") else ids == everything


def test_native_queries_use_no_python(spark, capsys):
    for n in ("op7_licence_digests", "op9_interleaved_shards"):
        REGISTRY[n](spark, SF_SMALL).explain()
        out = capsys.readouterr().out
        assert "Python" not in out and "Pandas" not in out and "Arrow" not in out


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    model = line_crf.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = {r.doc_id for r in compression_rules.score(docs).where("kept").collect()}
    kept &= {r.doc_id for r in line_crf.score(docs, model).where("predicted = 1").collect()}
    left = docs.where(docs.doc_id.isin(list(kept)))
    kept = {r.component_id for r in simhash_tiles.classes(left).collect()}
    left = docs.where(docs.doc_id.isin(list(kept)))
    kept -= {r.doc_id for r in template_windows.leaks(left, items).collect()}
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == kept and len(kept) < docs.count()
    total = {r.doc_id: r.doc_tokens for r in pieces}
    sums = {}
    for r in pieces:
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.length
    assert sums == total


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    empty = docs.limit(0)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near-duplicates",
                                                      "benchmark decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, SF_SMALL)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF_SMALL).count() == 0


def test_stages_take_nulls_and_other_columns(spark, edge_docs):
    docs = edge_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == edge_docs.columns
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, edge_docs, SF_SMALL).count() >= edge_docs.count()


def test_stages_take_columns_without_an_order(spark, edge_docs):
    docs = edge_docs.withColumn("tags", F.create_map(F.lit("a"), F.col("lang")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        out.collect()
