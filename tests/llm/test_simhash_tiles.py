"""SimHash classes against all pairs of fingerprints."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ebbflow.llm import simhash_tiles as SH

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, radius=4):
    fps = [(d, fingerprint(t)) for d, t in rows]
    nodes = sorted({f for _, f in fps})
    root = {f: f for f in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if bin(a ^ b).count("1") <= radius:
                root[find(a)] = find(b)
    least = {}
    for d, f in fps:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return sorted(((d, f, least.get(find(f))) for d, f in fps), key=repr)


def check(docs):
    got = SH.classes(docs).select("doc_id", "fp", "component_id")
    got = sorted(((r[0], r[1] & (2**64 - 1), r[2]) for r in got.collect()), key=repr)
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_equals_all_pairs(corpus):
    check(corpus)


def test_edges(edge_docs):
    check(edge_docs)
    assert SH.classes(edge_docs.limit(0)).count() == 0


def test_spark_hash_agrees(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] & (2**64 - 1)
    assert got == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_links_of_dense_and_hot_buckets(spark, monkeypatch):
    """Chains of near fingerprints, and more fingerprints in one bucket than a chunk holds."""
    monkeypatch.setattr(SH, "HOT_BUCKET", 50)
    monkeypatch.setattr(SH, "TILE", 16)
    rnd = random.Random(3)
    fps = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(40):
            fps.add(x)
            for b in rnd.sample(range(64), rnd.choice([1, 2, 4, 5])):
                x ^= 1 << b
    fps |= {0xABCD << 48 | rnd.getrandbits(40) for _ in range(300)}
    fps = sorted(fps)
    for n_nodes in (10, 1 << 30):  # fewest blocks, and more
        nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
        roots = {r.fp & (2**64 - 1): r.root & (2**64 - 1) for r in SH.components(SH.links(nodes, n_nodes, 4)).collect()}
        got = {}
        for f in fps:
            got.setdefault(roots.get(f, f), set()).add(f)
        want = {}
        for d, f, c in plain_nodes(fps):
            want.setdefault(c, set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def plain_nodes(fps):
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 4
    label = np.arange(len(x))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return [(i, f, int(c)) for i, (f, c) in enumerate(zip(fps, label))]
        label = new


def test_keep_one(corpus, edge_docs):
    kept = SH.keep_one(corpus)
    want = {c for _, _, c in plain([(r.doc_id, r.text) for r in corpus.collect()])}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want) and kept.columns == corpus.columns
    few = SH.keep_one(edge_docs)
    named = [r.doc_id for r in few.collect() if r.doc_id is not None]
    assert len(named) == len(set(named)) and few.columns == edge_docs.columns
    assert few.where("doc_id is null").count() == 2
    assert SH.keep_one(edge_docs.limit(0)).count() == 0


def test_keep_one_takes_columns_without_an_order(spark, edge_docs):
    docs = edge_docs.withColumn("tags", F.create_map(F.lit("a"), F.col("lang"))).withColumn("list", F.array(F.create_map(F.lit(1), F.lit(2))))
    kept, plain = SH.keep_one(docs), SH.keep_one(edge_docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.select(*edge_docs.columns).collect())) == sorted(map(repr, plain.collect()))
