"""Exact KNN vote against numpy brute force (with duplicate points and exact matches)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ebbflow.operators.knn import _cell_topk, knn_classify, neighbours


def _data(spark, n_train=300, n_test=60, d=8, seed=1):
    rng = np.random.default_rng(seed)
    tr = rng.normal(size=(n_train, d)).round(1)
    te = rng.normal(size=(n_test, d)).round(1)
    te[:5] = tr[:5]                     # exact matches -> zero distance
    ytr = rng.integers(0, 4, n_train)
    train = spark.createDataFrame([(i, tr[i].tolist(), int(ytr[i])) for i in range(n_train)],
                                  "vec_id long, embedding array<double>, label int")
    test = spark.createDataFrame([(10_000 + i, te[i].tolist(), 0) for i in range(n_test)],
                                 "vec_id long, embedding array<double>, label int")
    return tr, ytr, te, train, test


def _brute(tr, ytr, te, k, weights, metric):
    out = {}
    for i, q in enumerate(te):
        d = np.sqrt(((tr - q) ** 2).sum(1)) if metric == "euclidean" else np.abs(tr - q).sum(1)
        idx = np.lexsort((np.arange(len(tr)), d))[:k]
        if weights == "distance":
            w = np.where(d[idx] == 0, 1.0, 0.0) if (d[idx] == 0).any() else 1.0 / d[idx]
        else:
            w = np.ones(k)
        score = {}
        for j, ww in zip(idx, w):
            score[int(ytr[j])] = score.get(int(ytr[j]), 0.0) + ww
        out[10_000 + i] = min(score, key=lambda c: (-score[c], c))
    return out


def test_knn_matches_brute_force(spark):
    tr, ytr, te, train, test = _data(spark)
    for weights, metric in (("distance", "euclidean"), ("uniform", "manhattan")):
        got = {r["qid"]: r["predicted"] for r in knn_classify(train, test, k=7, weights=weights, metric=metric,
                                                               block_rows=64).collect()}
        assert got == _brute(tr, ytr, te, 7, weights, metric)


def test_text_ids_and_ties(spark):
    pts = [(f"r{i}", [float(i % 3), 0.0], i % 2) for i in range(30)]
    ref = spark.createDataFrame(pts, "vec_id string, embedding array<double>, label int")
    got = neighbours(ref, ref, k=4, block_rows=7).where("qid = 'r1'").orderBy("rank").collect()
    same = sorted(p[0] for p in pts if p[1][0] == 1.0)
    assert [r["nid"] for r in got] == same[:4] and all(r["dist"] == 0.0 for r in got)


def test_neighbours_exactly_k(spark):
    _, _, _, train, test = _data(spark)
    n = neighbours(train, test, k=5, block_rows=50)
    assert {r["count"] for r in n.groupBy("qid").count().collect()} == {5}


def _clustered(spark, n, seed=3, d=4):
    """References and queries around 40 centres; a third of the references is one point."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, d)) * 20
    tr = centres[rng.integers(0, 40, n)] + rng.normal(size=(n, d))
    tr[::3] = tr[0]
    te = centres[rng.integers(0, 40, n // 10)] + rng.normal(size=(n // 10, d))
    frame = lambda x, at: spark.createDataFrame([(at + i, v.tolist(), i % 2) for i, v in enumerate(x)],
                                                "vec_id long, embedding array<double>, label int")
    return tr, te, frame(tr, 0), frame(te, 10**6)


def test_index_is_exact_with_a_hot_point(spark):
    tr, te, train, test = _clustered(spark, 1500)
    for metric in ("euclidean", "manhattan"):
        got = {}
        for r in neighbours(train, test, k=6, metric=metric, block_rows=50).orderBy("qid", "rank").collect():
            got.setdefault(r["qid"], []).append(r["nid"])
        for i, q in enumerate(te):
            d = np.sqrt(((tr - q) ** 2).sum(1)) if metric == "euclidean" else np.abs(tr - q).sum(1)
            assert got[10**6 + i] == np.lexsort((np.arange(len(tr)), d))[:6].tolist()


def test_index_skips_most_distances_of_clustered_points(spark):
    from ebbflow.operators.knn import visited_share
    shares = [visited_share(*_clustered(spark, n)[2:], k=6, block_rows=50) for n in (1000, 4000)]
    assert shares[0] < 0.6 and shares[1] < shares[0]  # the work grows below the square


def test_fewer_references_than_k_and_none(spark):
    _, _, train, test = _clustered(spark, 60)
    few = neighbours(train.where("vec_id < 4"), test, k=6)
    assert few.count() == 4 * test.count()
    assert neighbours(train.limit(0), test, k=6).count() == 0 and neighbours(train, test.limit(0), k=6).count() == 0


def test_rings_of_near_pivots_share_a_block(spark):
    from ebbflow.operators.knn import build_index
    _, _, _, train, _ = _data(spark, n_train=3000)
    index, _ = build_index(train.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"), 3000, "euclidean", 4096)
    assert len(index.pivots) > 10 and set(index.first) == {0} and set(index.blocks) == {1}  # a query is sent once


def test_cell_is_exact_far_from_the_origin_and_within_the_limit():
    rng = np.random.default_rng(5)
    q, t = rng.normal(size=(40, 6)) * 1e-3 + 1e4, rng.normal(size=(500, 6)) * 1e-3 + 1e4
    t[::5] = t[0]
    q[0] = t[0]
    frame = lambda x, **more: pd.DataFrame({"id": np.arange(len(x)), "vec": list(x), **more})
    for metric in ("euclidean", "manhattan"):
        diff = q[:, None] - t[None]
        d = np.sqrt((diff * diff).sum(2)) if metric == "euclidean" else np.abs(diff).sum(2)
        upper = np.sort(d, axis=1)[:, 3]
        for limit in (None, upper):
            got = _cell_topk(7, metric)(frame(q, **({} if limit is None else {"upper": limit})), frame(t, label=0))
            for i in range(len(q)):
                mine = got[got.qid == i].sort_values(["dist", "nid"])
                want = [j for j in np.lexsort((np.arange(len(t)), d[i]))[:7] if limit is None or d[i, j] <= limit[i]]
                assert mine.nid.tolist()[:len(want)] == want and (mine.dist.to_numpy()[:len(want)] == d[i, want]).all()
                assert limit is None or len(mine) <= 7
