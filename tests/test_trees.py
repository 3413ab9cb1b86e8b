"""Tree ensembles against a plain grower: exhaustive split search, one split at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.operators import trees as T

SPECS = [
    T.TreeSpec("newton", 4, 0.3, 3, l2=1.0, min_hessian=1.0, subsample=0.7, weights=3.0, from_prior=False),
    T.TreeSpec("residuals", 4, 0.2, 4, by_hessian=False),
    T.TreeSpec("leaves", 3, 0.2, 6, leaves=7, min_rows=5, min_hessian=1e-3, weights="balanced"),
    T.TreeSpec("leaves only", 2, 0.2, None, leaves=9, min_rows=5),
    T.TreeSpec("forest", 5, forest=True, min_split=5, weights="balanced", max_features=2),
    T.TreeSpec("shallow forest", 4, depth=3, forest=True, max_features=None),
]


def data(n=300, d=5, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 1)
    x[:, 3] = rng.integers(0, 3, n)
    y = (x[:, 0] + 0.7 * x[:, 1] * (x[:, 3] > 0) + rng.normal(size=n) * 0.5 > 0.4).astype(int)
    return x, y, np.where(np.arange(n) % 5 == 4, -1, np.arange(n) % 4)


def frame(spark, x, y, fold):
    rows = [(f"r{i}", int(y[i]), None if fold[i] < 0 else int(fold[i]), *map(float, x[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "id string, label int, fold int, " + ", ".join(f"x{j} double" for j in range(x.shape[1])))


def plain_tree(spec, fit, tree, bins, g, h, times, widths):
    """Grown one split at a time, each time the open leaf with the largest gain."""
    nodes = {0: np.flatnonzero(times > 0)}  # path number: root 0, children 2 p + 1 and 2 p + 2
    names = {0: 0}                          # node number as the grower gives them, for the features tried
    splits, leaves = {}, {0: 0}

    def sums(rows):
        t = times[rows]
        return np.array([(g[rows] * t).sum(), (h[rows] * t).sum(), t.sum()])

    def score(s):
        d = s[1 if spec.by_hessian else 2] + spec.l2
        return s[0] ** 2 / d if d > 1e-12 else 0.0

    def search(path):
        rows, whole, best = nodes[path], sums(nodes[path]), None
        if whole[2] < max(spec.min_split, 2 * spec.min_rows):
            return None
        for f in T.tried(spec, fit, tree, names.get(path, 0), bins.shape[1]):
            for b in range(widths[f] - 1):
                left = sums(rows[bins[rows, f] <= b])
                right = whole - left
                if min(left[2], right[2]) < max(1, spec.min_rows) or min(left[1], right[1]) < spec.min_hessian:
                    continue
                gain = score(left) + score(right) - score(whole)
                if gain > 1e-10 * max(1, score(whole)) and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, int(f), b)
        return best

    open_ = {0: search(0)}
    while open_ and (spec.leaves is None or len(leaves) < spec.leaves):
        ready = [p for p, s in open_.items() if s and (spec.depth is None or leaves[p] < spec.depth)]
        if not ready:
            break
        path = max(ready, key=lambda p: (open_[p][0], -p))
        _, f, b = splits[path] = open_.pop(path)
        rows, level = nodes[path], leaves.pop(path)
        for k, own in ((2 * path + 1, rows[bins[rows, f] <= b]), (2 * path + 2, rows[bins[rows, f] > b])):
            nodes[k], leaves[k] = own, level + 1
            open_[k] = search(k)
    out = np.zeros(len(bins))
    for i in range(len(bins)):
        p = 0
        while p in splits:
            _, f, b = splits[p]
            p = 2 * p + (1 if bins[i, f] <= b else 2)
        s = sums(nodes[p])
        d = s[1] + (0 if spec.forest else spec.l2)
        out[i] = (s[0] / d if d > 1e-12 else 0.0) * (1 if spec.forest else spec.rate)
    return out, len(leaves)


def plain_fit(fit, bins, y, fold, hashes, widths):
    spec, rows = fit.spec, fit.rows(fold)
    w = np.where(y > 0, fit.weight[1], fit.weight[0]) * rows
    total = np.zeros(len(y))
    for t in range(spec.trees):
        times = T.drawn(spec, fit.number, t, hashes) * rows
        p = 1 / (1 + np.exp(-(fit.start + total)))
        g, h = (w * y, w) if spec.forest else (w * (y - p), w * p * (1 - p))
        value, leaves = plain_tree(spec, fit.number, t, bins, g, h, times, widths)
        assert spec.leaves is None or leaves <= spec.leaves
        total = total + value
    return fit.probability(total) if not spec.forest else total / spec.trees


def grown(spark, rows, names, specs, folds):
    cuts = T.cuts_of(rows.where("fold is not null"), names)
    blocks = T.blocks_of(rows, names, cuts)
    fits = T.prepare_fits(specs, folds, blocks)
    T.grow(blocks, [len(c) + 1 for c in cuts], fits)
    return cuts, blocks, fits


def held_out(blocks, fits):
    out = {}
    for r in T.predictions(blocks, fits).collect():
        out.setdefault(r.fit, {})[r.id] = r.probability
    return out


@pytest.mark.parametrize("block_rows", [16_384, 37])
def test_trees_equal_the_plain_grower(spark, monkeypatch, block_rows):
    monkeypatch.setattr(T, "BLOCK_ROWS", block_rows)
    x, y, fold = data()
    names = [f"x{j}" for j in range(x.shape[1])]
    specs = [s for s in SPECS if not s.max_features]  # the features tried depend on the numbering of nodes
    cuts, blocks, fits = grown(spark, frame(spark, x, y, fold).repartition(3), names, specs, [1, None])
    assert blocks.count() == (1 if block_rows > 300 else blocks.count()) and (block_rows > 300 or blocks.count() > 3)
    ids, bins, hashes = [], [], []
    for r in blocks.collect():
        ids += r.ids
        bins.append(np.frombuffer(r.bins, np.uint8).reshape(len(r.ids), -1))
        hashes.append(np.frombuffer(r.hashes, np.int64))
    at = np.array([int(i[1:]) for i in ids])
    bins, hashes = np.concatenate(bins).astype(np.int64), np.concatenate(hashes)
    got = held_out(blocks, fits)
    for fit in fits:
        want = plain_fit(fit, bins, y[at], fold[at], hashes, [len(c) + 1 for c in cuts])
        mine = [k for k in range(len(at)) if fold[at[k]] == (-1 if fit.fold is None else fit.fold)]
        assert set(got[fit.number]) == {ids[k] for k in mine}
        assert np.allclose([got[fit.number][ids[k]] for k in mine], want[mine], atol=1e-9), (fit.spec.name, fit.fold)
        assert len(fit.done.first) == fit.spec.trees


def test_layout_and_partitions_do_not_change_trees(spark, monkeypatch):
    x, y, fold = data(seed=2)
    names = [f"x{j}" for j in range(x.shape[1])]
    results = []
    specs = [SPECS[0], SPECS[2], SPECS[4]]
    for block_rows, parts, nodes in ((16_384, 1, 1500), (50, 4, 30)):
        monkeypatch.setattr(T, "BLOCK_ROWS", block_rows)
        monkeypatch.setattr(T, "NODES", nodes)
        _, blocks, fits = grown(spark, frame(spark, x, y, fold).repartition(parts), names, specs, [0, None])
        results.append(held_out(blocks, fits))
    for other in results[1:]:
        assert other.keys() == results[0].keys()
        for k in other:
            assert other[k].keys() == results[0][k].keys()
            assert np.allclose([other[k][i] for i in sorted(other[k])], [results[0][k][i] for i in sorted(other[k])], atol=1e-9)


def test_forest_draws_and_features():
    spec = T.TreeSpec("forest", 3, forest=True, max_features=2)
    h = np.arange(20_000)
    times = T.drawn(spec, 0, 1, h)
    assert abs(times.mean() - 1) < 0.03 and abs((times == 0).mean() - np.exp(-1)) < 0.02
    assert (times == T.drawn(spec, 0, 1, h)).all() and (times != T.drawn(spec, 0, 2, h)).any()
    assert len(T.tried(spec, 0, 1, 5, 9)) == 2 and len({tuple(T.tried(spec, 0, 1, n, 9)) for n in range(30)}) > 10
    kept = T.drawn(T.TreeSpec("s", 1, subsample=0.8), 0, 0, h)
    assert set(kept) == {0.0, 1.0} and abs(kept.mean() - 0.8) < 0.02


def test_min_split_is_the_size_of_the_node():
    spec = T.TreeSpec("f", 1, forest=True, min_split=5)
    x = np.zeros((3, 3))
    x[:, 0], x[:, 2] = (2, 2, 1), (0, 2, 2)  # bins: label 1 two of them, then one, none
    sums = np.array([[2.0, 0.0, 0.0], [2.0, 2.0, 0.0], [2.0, 2.0, 0.0]])
    assert T.best_split(spec, sums, np.array([0]), np.array([3]))["feature"] == -1  # 4 rows
    sums[:, 1] += (0, 1, 1)
    assert T.best_split(spec, sums, np.array([0]), np.array([3]))["bin"] == 0       # 5 rows, a child may have 2


def test_a_worker_without_margins_starts_over(spark):
    x, y, fold = data(seed=3)
    names = [f"x{j}" for j in range(x.shape[1])]
    _, blocks, (fit,) = grown(spark, frame(spark, x, y, fold), names, SPECS[:1], [None])
    block = next(T.read_blocks([blocks.toArrow().to_batches()[0]]))
    full = T.margin("a", fit, block)
    part = T.Fit(fit.number, fit.spec, None, fit.prior, fit.weight)
    for k in (1, 3, 4):  # a worker that has seen some of the trees
        ends = [*fit.done.first, len(fit.done.feature)]
        part.done = T.Trees(fit.done.feature[:ends[k]], fit.done.bin[:ends[k]], fit.done.left[:ends[k]], fit.done.value[:ends[k]], fit.done.first[:k])
        last = T.margin("b", part, block)
    assert np.allclose(last, full)


def test_defined_results(spark):
    x, y, fold = data(60)
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = frame(spark, x, y, fold).withColumn("x0", F.when(F.col("x0") > 0, F.col("x0"))).withColumn("x1", F.when(F.col("x1") < 0, float("nan")).otherwise(F.col("x1")))
    rows = rows.unionByName(rows.limit(3).withColumn("label", F.lit(None).cast("int")))
    _, blocks, fits = grown(spark, rows, names, SPECS, [0, None])
    assert all(len(p) for p in held_out(blocks, fits).values()) and sum(len(r.ids) for r in blocks.collect()) == 60
    _, blocks, fits = grown(spark, rows.where("label = 1"), names, SPECS, [None])
    assert {p for d in held_out(blocks, fits).values() for p in d.values()} == {1.0}
    _, blocks, fits = grown(spark, rows.limit(0), names, SPECS, [0, None])
    assert held_out(blocks, fits) == {}


def test_saved_model_scores_the_same(spark, tmp_path):
    x, y, fold = data(seed=5)
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = frame(spark, x, y, fold)
    cuts, blocks, fits = grown(spark, rows, names, [SPECS[2], SPECS[4]], [None])
    for fit in fits:
        model = T.TreeModel(names, cuts, fit)
        model.save(spark, f"{tmp_path}/m{fit.number}")
        got = {r.id: r.probability for r in T.TreeModel.load(spark, f"{tmp_path}/m{fit.number}").predict(rows.where("fold is null"), "id", ["label"]).collect()}
        want = held_out(blocks, [fit])[fit.number]
        assert got.keys() == want.keys() and np.allclose([got[i] for i in want], list(want.values()))


def test_subtrees_of_forests_grow_in_groups(spark, monkeypatch):
    x, y, fold = data(400, seed=7)
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = frame(spark, x, y, fold)
    specs = [T.TreeSpec("deep", 3, forest=True, min_split=3, weights="balanced"), SPECS[5]]
    results = []
    for subtree, block_rows in ((1 << 17, 16_384), (60, 16_384), (60, 90)):
        monkeypatch.setattr(T, "SUBTREE", subtree)
        monkeypatch.setattr(T, "BLOCK_ROWS", block_rows)
        cuts = T.cuts_of(rows.where("fold is not null"), names)
        blocks = T.blocks_of(rows, names, cuts)
        fits = T.prepare_fits(specs, [0, None], blocks)
        passes = T.grow(blocks, [len(c) + 1 for c in cuts], fits)
        assert passes == 0 if subtree > 400 else 0 < passes < 20  # small tables need none, whatever the depth
        results.append((held_out(blocks, fits), [sorted(np.diff([*f.done.first, len(f.done.feature)])) for f in fits]))
        for f in fits[1::2]:  # the trees in the table are those that gave the predictions
            got = {r.id: r.probability for r in T.TreeModel(names, cuts, f).predict(rows.where("fold is null"), "id").collect()}
            assert got.keys() == results[-1][0][f.number].keys() and np.allclose([got[i] for i in got], [results[-1][0][f.number][i] for i in got])
    for other in results[1:]:
        assert other[1] == results[0][1]
        for k in other[0]:
            assert other[0][k].keys() == results[0][0][k].keys() and np.allclose([other[0][k][i] for i in other[0][k]], [results[0][0][k][i] for i in other[0][k]], atol=1e-9)


def test_rows_of_a_large_partition_are_dealt_to_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 50)
    x, y, fold = data(400, seed=8)
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = frame(spark, x, y, fold).coalesce(1)
    blocks = T.blocks_of(rows, names, T.cuts_of(rows, names))
    assert blocks.select(F.input_file_name()).distinct().count() == 8  # one file before, and so one task in every pass


def test_boosted_fits_of_few_rows_need_no_passes(spark, monkeypatch):
    x, y, fold = data(400, seed=9)
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = frame(spark, x, y, fold)
    specs = [*SPECS[:4], T.TreeSpec("few features", 3, depth=3, max_features=2)]
    results = []
    for alone, block_rows in ((1 << 20, 16_384), (1 << 20, 60), (0, 60)):
        monkeypatch.setattr(T, "ALONE", alone)
        monkeypatch.setattr(T, "BLOCK_ROWS", block_rows)
        cuts = T.cuts_of(rows.where("fold is not null"), names)
        blocks = T.blocks_of(rows, names, cuts)
        fits = T.prepare_fits(specs, [0, None], blocks)
        passes = T.grow(blocks, [len(c) + 1 for c in cuts], fits)
        assert passes == 0 if alone else passes >= 12  # one after the other, whatever the rows
        results.append((held_out(blocks, fits), [np.diff([*f.done.first, len(f.done.feature)]).tolist() for f in fits]))
    for other in results[1:]:
        assert other[1] == results[0][1]
        for k in other[0]:
            assert other[0][k].keys() == results[0][0][k].keys() and np.allclose([other[0][k][i] for i in other[0][k]], [results[0][0][k][i] for i in other[0][k]], atol=1e-9)


def test_splits_of_many_nodes_are_those_of_each():
    rng = np.random.default_rng(3)
    widths, spec, weight = np.array([2, 9, 40, 3]), T.TreeSpec("f", 1, forest=True, min_split=4), (0.7, 2.5)
    bins = np.stack([rng.integers(0, w, 500) for w in widths], axis=1).astype(np.uint8)
    labels, times, place = rng.integers(0, 2, 500), rng.integers(1, 4, 500), np.append(np.arange(60), rng.integers(0, 60, 440))
    features = np.array([np.sort(rng.permutation(4)[:2]) for _ in range(60)])
    got = T.best_splits_of(spec, weight, np.stack([labels * times, times]).astype(float), bins[np.arange(500)[:, None], features[place]], place, features, widths)
    for n in range(60):
        own = np.flatnonzero(place == n)
        x = np.stack([labels * weight[1] * times, np.where(labels, weight[1], weight[0]) * times, times])[:, own]
        hist = np.concatenate([[np.bincount(bins[own, f], c, widths[f]) for c in x] for f in features[n]], axis=1)
        want = T.best_split(spec, hist, features[n], widths[features[n]])
        assert (got[0][n], got[1][n]) == (want["feature"], want["bin"])
        assert want["feature"] < 0 or np.isclose(got[2][n][1], want["sums"][2])
