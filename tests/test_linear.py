"""Newton fits: optimality in plain numpy, calibration, edge cases; and the shared comparison."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.operators import compare as C, linear as L
from ebbflow.plans import churn
from conftest import SF_SMALL


def data(n=400, d=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 10, 0.1, 1] + [0, 5, 0, 100]
    y = ((x - x.mean(0)) / x.std(0) @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=n) > 0.8).astype(int)
    return x, y, np.where(np.arange(n) % 5 == 4, -1, np.arange(n) % 4)


def frame(spark, x, y, fold):
    rows = [(f"r{i}", int(y[i]), None if fold[i] < 0 else int(fold[i]), *map(float, x[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "id string, label int, fold int, " + ", ".join(f"x{j} double" for j in range(x.shape[1])))


def gradient(fit, x, y, fold):
    """Of the objective at the fitted coefficients, from scratch."""
    rows = (fold >= 0) & (fold != (-1 if fit.fold is None else fit.fold))
    x, y = x[rows], y[rows]
    z = np.c_[(x - x.mean(0)) / x.std(0), np.ones(len(x))]
    w = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    m = z @ fit.beta
    if fit.loss == "logistic":
        first = 1 / (1 + np.exp(-m)) - y
    else:
        s = 2.0 * y - 1
        first = -s * np.clip((1 - s * m) / L.ROUNDS[-1], 0, 1)
    return (w * first) @ z + np.append(fit.beta[:-1] / fit.c, 0)


@pytest.mark.parametrize("block_rows", [16_384, 60])
def test_fits_are_optimal_on_every_fold(spark, monkeypatch, block_rows):
    monkeypatch.setattr(L, "BLOCK_ROWS", block_rows)
    x, y, fold = data()
    blocks = L.blocks_of(frame(spark, x, y, fold).repartition(4), [f"x{j}" for j in range(4)])
    fits = L.make_fits([("logistic", 10.0), ("logistic", 0.01), ("hinge", 1.0), ("hinge", 10.0)], [0, 3, None], blocks, 4)
    L.newton(blocks, fits)
    for f in fits:
        assert np.abs(gradient(f, x, y, fold)).max() < 1e-5, (f.loss, f.c, f.fold)
        assert f.steps < 60


def test_calibration_is_held_out_and_smoothed(spark):
    x, y, fold = data(seed=2)
    blocks = L.blocks_of(frame(spark, x, y, fold), [f"x{j}" for j in range(4)])
    fits = L.make_fits([("hinge", 10.0)], [0, 1, 2, 3, None], blocks, 4)
    L.newton(blocks, fits)
    a, b = L.cross_fit(blocks, fits[:4], fits[4])
    held = L.predictions(blocks, fits[:4]).collect()
    assert sorted(r.id for r in held) == sorted(f"r{i}" for i in range(400) if fold[i] >= 0)  # each row by the fit that left it out
    m, t = np.array([r.margin for r in held]), np.array([r.label for r in held])
    target = np.where(t > 0, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
    p = 1 / (1 + np.exp(-(a * m + b)))
    assert abs(((p - target) * m).sum()) < 1e-5 and abs((p - target).sum()) < 1e-5 and a > 0
    assert all(f.platt == (a, b) for f in fits)


def test_saved_model_and_predictions_agree(spark, tmp_path):
    x, y, fold = data(seed=3)
    rows = frame(spark, x, y, fold)
    names = [f"x{j}" for j in range(4)]
    blocks = L.blocks_of(rows, names)
    for loss in ("logistic", "hinge"):
        fits = L.make_fits([(loss, 1.0)], [0, 1, 2, 3, None], blocks, 4)
        L.newton(blocks, fits)
        if loss == "hinge":
            L.cross_fit(blocks, fits[:4], fits[4])
        L.LinearModel(names, fits[4]).save(spark, f"{tmp_path}/{loss}")
        got = {r.id: r.probability for r in L.LinearModel.load(spark, f"{tmp_path}/{loss}").predict(rows.where("fold is null"), "id").collect()}
        want = {r.id: r.probability for r in L.predictions(blocks, [fits[4]]).collect()}
        assert got.keys() == want.keys() and np.allclose([got[i] for i in want], list(want.values()))


def test_defined_results(spark):
    x, y, fold = data(60)
    x[:, 2] = 7  # a constant column
    names = [f"x{j}" for j in range(4)]
    rows = frame(spark, x, y, fold).withColumn("x0", F.when(F.col("id") != "r1", F.col("x0")))
    rows = rows.unionByName(rows.limit(2).withColumn("label", F.lit(None).cast("int")))
    blocks = L.blocks_of(rows, names)
    fits = L.make_fits([("logistic", 1.0), ("hinge", 1.0)], [0, None], blocks, 4)
    L.newton(blocks, fits)
    assert all(np.isfinite(f.beta).all() and abs(f.beta[2]) < 1e-9 for f in fits)
    assert L.predictions(blocks, fits).where("id = 'r1'").count() == 0
    for part, want in ((rows.where("label = 1"), {1.0}), (rows.limit(0), set())):
        blocks = L.blocks_of(part, names)
        fits = L.make_fits([("logistic", 1.0)], [None], blocks, 4)
        L.newton(blocks, fits)
        assert {r.probability for r in L.predictions(blocks, fits).collect()} == want


def test_all_families_in_shared_passes(spark):
    split = churn.split_table(spark, SF_SMALL)
    few = {"XGBoost": [dict(C.PUBLISHED["XGBoost"][0], n_estimators=2)], "Gradient Boosting": [dict(C.PUBLISHED["Gradient Boosting"][0], n_estimators=2)],
           "LightGBM": [dict(C.PUBLISHED["LightGBM"][0], n_estimators=2)], "Random Forest": [dict(C.PUBLISHED["Random Forest"][0], n_estimators=3)]}
    table, models = C.compare(split, C.PUBLISHED | few)
    rows = table.collect()
    assert {r["model"] for r in rows} == set(C.PUBLISHED) == set(models) and sorted(r["rank"] for r in rows) == list(range(7))
    assert all(0 <= r["roc_auc"] <= 1 and r["cv_roc_auc_mean"] is not None and r["best_params"] for r in rows)
    n_test = split.where("split = 'test'").count()
    for name in set(models) - {"KNN"}:
        assert models[name].predict(split.where("split = 'test'"), "customer_id").count() == n_test


def test_best_of_several_configurations(spark):
    split = churn.split_table(spark, SF_SMALL)
    table, models = C.compare(split, {"Logistic Regression": C.full_grid()["Logistic Regression"],
                                      "Gradient Boosting": C.grid(learning_rate=[0.1], max_depth=[2, 3], n_estimators=[2])})
    assert {r["model"] for r in table.collect()} == {"Logistic Regression", "Gradient Boosting"} and len(models) == 2
    sizes = {k: len(v) for k, v in C.full_grid().items()}
    assert sizes == {"Logistic Regression": 4, "XGBoost": 16, "Gradient Boosting": 8, "SVM": 3, "LightGBM": 16, "Random Forest": 12, "KNN": 12}
