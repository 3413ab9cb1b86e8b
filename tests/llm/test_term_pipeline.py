"""Ranked lexical search against a plain version, and its edge cases."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbflow.llm import term_pipeline

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, Counter(t), len(t)) for i, t in bags if t]
    total, df = sum(n for *_, n in bags), Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, bag, n in bags:
            m = 25 + 75 * n * len(bags) // total
            s = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t in terms(text) if bag[t])
            scored += [(-s, i is not None, i or 0)] * (s > 0)
        out += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def ranked(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for name in ("block", "owner", "terms", "item", "score", "bundle", "rank"):
        d = d.withColumn(name, F.lit(1))
    d = d.withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    return sorted(map(tuple, term_pipeline.rank(d, spark.createDataFrame(items, "item_id long, text string")).collect()), key=repr)


def test_whole_tables_equal_the_plain_version(spark, corpus):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = sorted(map(tuple, term_pipeline.rank(corpus, items).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    assert got == plain([(r.doc_id, r.text) for r in corpus.collect()], [(r.item_id, r.text) for r in items.collect()])


@pytest.mark.parametrize("block, bundle, owners", [(4096, 128, 4), (3, 2, 4), (2, 1, 1)])
def test_edges_in_any_layout(spark, monkeypatch, block, bundle, owners):
    for name, value in (("BROADCAST_TERMS", 100 if block > 3 else 0), ("BLOCK", block), ("BUNDLE", bundle), ("OWNERS", owners), ("POSTINGS", 5 * block)):
        monkeypatch.setattr(term_pipeline, name, value)
    docs = [(1, "The cat sat; the CAT ran"), (2, None), (3, ""), (4, " .,;\x7f{}\x00 "), (5, "Ähre ähre 漢字 déjà-vu\x00cat"), (None, "cat alone"),
            (7, "cat " * 30000 + "dog"), (8, "dog cat"), (8, "dog cat"), (9, "dog cat"), (10, "x1 2y"), (11, "nothing asked for")]
    items = [(0, "the cat, the dog"), (1, None), (2, ""), (3, "ähre Ähre 漢字"), (4, "unseen words only"), (5, "cat cat cat"), (None, "dog")]
    assert ranked(spark, docs, items) == plain(docs, items)


def test_repeated_items_and_empty_tables(spark):
    docs = [(i, f"word{i % 7} common") for i in range(40)]
    items = [(1, "word3 common"), (1, "word3 common"), (2, "word5")]
    got = ranked(spark, docs, items)
    assert got == plain(docs, items) and len([r for r in got if r[0] == 1]) == 20  # each row of an item is ranked
    assert ranked(spark, docs[:0], items) == [] and ranked(spark, docs, items[:0]) == [] and ranked(spark, docs[:0], items[:0]) == []
