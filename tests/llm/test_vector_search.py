"""Hard negatives and posting lists against brute force, and their edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import balanced_lists, slot_negatives
from ebbflow.llm.vectors import first_k
from conftest import SF_MID

SCHEMA = "vec_id long, embedding array<float>, label int"
INF = float("inf")


def negatives_plain(rows, k_pos=5, k_neg=3, low=50, high=95):
    """Every pair in Python integers."""
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (ai, al, av) in enumerate(rows):
        if ai % 50:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(av, v)), i, label) for b, (i, label, v) in enumerate(rows) if b != a and len(v) == len(av)),
                        key=lambda x: x[:2])
        for p, pi, _ in [x for x in scored if x[2] == al][:k_pos]:
            ok = [x for x in scored if x[2] != al and -p * low <= -x[0] * 100 <= -p * high][:k_neg]
            out += [(ai, pi, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(ok)]
    return sorted(out)


def mined(df, **options):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in slot_negatives.mine(df, F.col("vec_id") % 50 == 0, **options).select(cols).collect())


def random_rows(n, dim=6, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).round(1)
    x[:copies] = x[0]
    return [(int(i), [float(c) for c in np.float32(v)], int(rng.integers(3))) for i, v in enumerate(x)]


def test_negatives_equal_all_pairs(spark):
    for rows in (random_rows(400), random_rows(400, seed=2, copies=150)):  # many ties; a third of one vector
        assert mined(spark.createDataFrame(rows, SCHEMA).repartition(5)) == negatives_plain(rows)


def test_negatives_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(slot_negatives, "ANCHORS", 2)
    monkeypatch.setattr(slot_negatives, "ROWS", 40)
    monkeypatch.setattr(slot_negatives, "CHUNK", 16)
    rows = random_rows(400, seed=3)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3)) == negatives_plain(rows)


def test_negatives_defined_results(spark):
    rows = random_rows(120, seed=4)
    rows += [(None, [1.0] * 6, 1), (200, None, 1), (250, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (300, [1.0, INF, 1.0, 1.0, 1.0, 1.0], 2), (350, [float("nan")] * 6, 2),
             (400, [1.0] * 6, None), (450, [1.0] * 5, 1), (500, [], 1), (550, [0.0] * 6, 1), (600, [-1.0] * 6, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "score", "rank", "limits", "slot", "anchor", "kind", "vec"):
        df = df.withColumn(name, F.lit("x"))
    df = df.withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    assert mined(df) == negatives_plain([r for r in rows if r[1] is None or len(r[1]) == 6])
    assert mined(df.limit(0)) == []
    assert mined(spark.createDataFrame(rows[:1], SCHEMA)) == []


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = random_rows(60, seed=5)
    assert mined(spark.createDataFrame(rows + rows, SCHEMA)) == negatives_plain(rows + rows)


def test_large_components_are_exact(spark):
    rows = [(0, [1e6, 1.0], 0), (1, [1e6, 3.0], 0), (2, [9e5, 5.0], 1), (3, [8e5, 0.5], 1), (4, [2.0**100, 2.0**90], 1), (5, [1e6, 1e6], 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == negatives_plain(rows)


def nearest_plain(rows, wanted, k):
    """{query_id: [(vec_id, score)]} by double products of all pairs."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for a, (i, v) in enumerate(rows):
        if i % wanted == 0:
            scored = sorted((-float((v * w).sum()), j) for b, (j, w) in enumerate(rows) if b != a)
            out.setdefault(i, []).extend((j, -s) for s, j in scored[:k])
    return out


def searched(df, wanted=20, k=20, **options):
    out = {}
    for r in balanced_lists.neighbours(df, F.col("vec_id") % wanted == 0, k, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF_MID.replace('0.01', '0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want, got = nearest_plain(rows, 20, 20), searched(df)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    vec = {i: np.array(v, np.float64) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 20 and len({i for i, _ in found}) == 20 and q not in {i for i, _ in found}
        assert [x[0] for x in found] == [x[0] for x in sorted(found, key=lambda x: (-x[1], x[0]))]
        for i, s in found:
            assert s == pytest.approx(float(vec[q] @ vec[i]), abs=1e-12)


def test_all_lists_read_is_exact(spark):
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = searched(df, recall=1.0), nearest_plain(rows, 20, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.99


def test_ties_of_a_hot_vector_go_to_the_smallest_ids(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 8))
    x[::3] = 4 * x[0]  # the longest vector: its copies are each other's nearest
    rows = [(i, [float(c) for c in np.float32(v)], 0) for i, v in enumerate(x)]
    got = searched(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert [i for i, _ in got[60]] == [i for i in range(0, 3000, 3) if i != 60][:20]
    assert len({s for _, s in got[60]}) == 1


def test_lists_defined_results(spark):
    rows = [(i, [float(x) for x in np.float32(np.random.default_rng(i).normal(size=4))], 1) for i in range(0, 30, 2)]
    odd = [(None, [1.0] * 4, 1), (40, None, 1), (60, [1.0, None, 1.0, 1.0], 1), (80, [0.0] * 4, 1), (100, [INF] * 4, 1), (120, [1.0] * 3, 1), (140, [], 1)]
    df = spark.createDataFrame(rows + odd + rows[:2], SCHEMA)
    for name in ("row", "score", "rank", "list", "segment", "query", "vec", "lists", "group"):
        df = df.withColumn(name, F.lit("x"))
    got = [tuple(r) for r in balanced_lists.neighbours(df, F.col("vec_id") % 20 == 0).select("query_id", "vec_id", "rank").collect()]
    assert sorted(q for q, *_ in got) == [0] * 32 + [20] * 16  # 17 rows, the query 0 twice: each has 16 others
    assert sorted(r for q, _, r in got if q == 20) == list(range(1, 17)) and [i for q, i, _ in got if q == 20].count(0) == 2
    assert searched(df.limit(0)) == {} and searched(spark.createDataFrame(rows[:1], SCHEMA)) == {}


def test_rows_of_other_lengths_of_norm(spark):
    """Inner products, not angles: long vectors win."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 8)) * rng.lognormal(0, 1, size=(2000, 1))
    rows = [(i, [float(c) for c in np.float32(v)], 0) for i, v in enumerate(x)]
    got = searched(spark.createDataFrame(rows, SCHEMA))
    want = nearest_plain([r[:2] for r in rows], 20, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 16))
    c = balanced_lists.balanced_centroids(x, 200)
    index = balanced_lists.Index(c, balanced_lists.graph(c), 1.0)
    row, at, d = index.search(x[:300], 1.2)
    true = np.sqrt(balanced_lists.squared(x[:300], c))
    wanted = true <= 1.2 * true.min(axis=1, keepdims=True)
    assert wanted[row, at].mean() > 0.98 and len(row) > 0.95 * wanted.sum()
    size = np.bincount(np.argmin(balanced_lists.squared(x, c), axis=1), minlength=len(c))
    assert abs(len(c) - 200) < 40 and size.max() < 6 * size.mean()


def test_segments_split_large_lists():
    assert balanced_lists.segments({0: 3, 1: 4, 2: 25, 3: 1, 4: 10}, 10) == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1), 4: (5, 1)}
    assert balanced_lists.segments({}, 10) == {}


def test_first_k_counts_copies_once():
    group, score, tie, same = (np.array(x) for x in ([0, 0, 0, 0, 1], [2.0, 2.0, 1.0, 3.0, 0.0], [5, 5, 1, 9, 1], [5, 5, 1, 9, 1]))
    assert first_k(group, score, tie, 3, same).tolist() == [3, 0, 2, 4] and first_k(group, score, tie, 2).tolist() == [3, 0, 4]
