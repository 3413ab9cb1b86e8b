"""Sharding against a plain sort of all rows."""

import hashlib
import zlib
from collections import Counter

import pytest

from ebbflow.llm import interleave as IL


def plain(rows, n_shards, seed=42):
    strata = {}
    for d, t, s in rows:
        raw = (t or "").encode()
        crc = zlib.crc32(raw)
        h = hashlib.md5(f"{seed}:{'' if d is None else d}:{crc}".encode()).hexdigest()
        strata.setdefault("0" if s is None else "1" + s, []).append((h, (d is not None, d or 0), crc, len(raw) + 16))
    order = []
    for s, members in strata.items():
        members.sort()
        order += [((2 * r + 1) / (2 * len(members)), s, r, m) for r, m in enumerate(members)]
    order.sort(key=lambda x: x[:3])
    out = []
    for p, (_, _, _, (_, d, crc, size)) in enumerate(order):
        shard = p * n_shards // len(order)
        first = -(-shard * len(order) // n_shards)
        out.append((d[1] if d[0] else None, size, crc, "rows", shard, p - first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["corpus", "edge_docs"])
@pytest.mark.parametrize("n_shards", [1, 7, 40])
def test_equals_plain_sort(request, which, n_shards):
    docs = request.getfixturevalue(which)
    got = sorted((tuple(r) for r in IL.shard(docs, n_shards).collect()), key=repr)
    assert got == plain([(r.doc_id, r.text, r.source) for r in docs.collect()], n_shards)


def test_counts_and_mixture(corpus):
    rows = IL.shard(corpus, 8)
    counts = Counter(r.shard for r in rows.collect())
    assert max(counts.values()) - min(counts.values()) <= 1
    total = Counter(r.source for r in corpus.collect())
    mixed = rows.join(corpus.select("doc_id", "source"), "doc_id").groupBy("shard", "source").count().collect()
    assert all(abs(r["count"] - total[r.source] / 8) <= 2 for r in mixed)


def test_empty(corpus):
    assert IL.shard(corpus.limit(0)).count() == 0
