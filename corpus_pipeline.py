"""Corpus pipeline: quality rules, quality classifier, near-duplicates, benchmark
decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs`` with the same
columns; the last returns packed pieces. ``run`` writes each stage's result to the shared
folder and reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbflow.llm import compression_rules, line_crf, nnls_packing, simhash_tiles, template_windows
from ebbflow.llm.store import write_once
from ebbflow.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return compression_rules.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = line_crf.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return line_crf.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_tiles.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return template_windows.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nnls_packing.digests(nnls_packing.pack(docs))


STAGES = [("quality rules", quality_rules), ("quality classifier", quality_classifier),
          ("near-duplicates", near_duplicates), ("benchmark decontamination", decontamination),
          ("packing", packing)]

#: Compression, a trained classifier and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
