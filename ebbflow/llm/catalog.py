"""One registered query per operator: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbflow.llm import (balanced_lists, byte_gru, compression_rules, interleave, licences, line_crf, nnls_packing,
                         pfor_tokens, revisits, simhash_tiles, slot_negatives, template_windows, term_pipeline)
from ebbflow.llm.oracle_sql import ORACLE  # noqa: F401 - read beside REGISTRY
from ebbflow.sources.tables import read_table

REGISTRY: dict = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_compression_bands(spark, sf_dir):
    return compression_rules.score(read_table(spark, sf_dir, "documents"))


@register
def op2_template_windows(spark, sf_dir):
    rows = template_windows.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "item_id", "n_matched", "n_windows", "kind")


@register
def op3_simhash_tiles(spark, sf_dir):
    rows = simhash_tiles.classes(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register
def op4_pfor_tokens(spark, sf_dir):
    path = pfor_tokens.write(read_table(spark, sf_dir, "documents"))
    return pfor_tokens.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op5_line_crf(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return line_crf.score(docs, line_crf.fit(docs, read_table(spark, sf_dir, "labels")))


@register
def op6_revisits(spark, sf_dir):
    rows = revisits.resolve(revisits.records_of_pages(read_table(spark, sf_dir, "pages")))
    return rows.select("record_id", "curl", "at", "response_id", "outcome", revisits.header_lines(F.col("headers")).alias("headers"))


@register
def op7_licence_digests(spark, sf_dir):
    return licences.scan(read_table(spark, sf_dir, "documents"))


@register
def op8_byte_gru(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return byte_gru.predict(docs, byte_gru.fit(docs))


@register
def op9_interleaved_shards(spark, sf_dir):
    rows = interleave.shard(read_table(spark, sf_dir, "documents"), n_shards=40)
    return rows.withColumn("grown_shard", F.lit(None).cast("int"))


@register
def op10_nnls_packing(spark, sf_dir):
    return nnls_packing.digests(nnls_packing.pack(read_table(spark, sf_dir, "documents")))


@register
def op11_slot_negatives(spark, sf_dir):
    vec_id, label = F.col("vec_id"), F.col("label")
    return slot_negatives.mine(read_table(spark, sf_dir, "embeddings"), anchor=vec_id % 50 == 0,
                               label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


@register
def op12_balanced_lists(spark, sf_dir):
    return balanced_lists.neighbours(read_table(spark, sf_dir, "embeddings"), query=F.col("vec_id") % 20 == 0)


@register
def op13_term_pipeline(spark, sf_dir):
    return term_pipeline.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
