"""Evaluation operators against brute force and the reference's saved report."""

import random

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import evaluate as EV


def _preds(spark, n=400, seed=5, levels=50):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.3)
        p = min(1.0, max(0.0, round(rnd.gauss(0.55 if y else 0.4, 0.2) * levels) / levels))
        rows.append((i, y, p, int(p >= 0.5)))
    return rows, spark.createDataFrame(rows, "id long, label int, probability double, prediction int")


def _auc_pairs(rows):
    pos = [p for _, y, p, _ in rows if y == 1]
    neg = [p for _, y, p, _ in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_ties_half_credit(spark):
    rows, df = _preds(spark)
    assert EV.roc_auc(df).first()["roc_auc"] == pytest.approx(_auc_pairs(rows), abs=1e-12)


def test_auc_invariant_under_monotone_map(spark):
    rows, df = _preds(spark)
    a = EV.roc_auc(df).first()["roc_auc"]
    b = EV.roc_auc(df.withColumn("probability", F.pow("probability", 3))).first()["roc_auc"]
    assert a == pytest.approx(b, abs=1e-12)


def test_pr_curve_and_ap_brute_force(spark):
    rows, df = _preds(spark)
    P = sum(y for _, y, _, _ in rows)
    curve = {r["threshold"]: r for r in EV.pr_curve(df).collect()}
    ap = 0.0
    for t in sorted({p for _, _, p, _ in rows}):
        tp = sum(1 for _, y, p, _ in rows if y == 1 and p >= t)
        fp = sum(1 for _, y, p, _ in rows if y == 0 and p >= t)
        assert curve[t]["tp"] == tp and curve[t]["fp"] == fp
        assert curve[t]["precision"] == pytest.approx(tp / (tp + fp))
        assert curve[t]["recall"] == pytest.approx(tp / P)
        at = sum(1 for _, y, p, _ in rows if y == 1 and p == t)
        ap += at / P * tp / (tp + fp)
    assert curve[None]["precision"] == 1.0 and curve[None]["recall"] == 0.0
    assert EV.average_precision(df).first()["avg_precision"] == pytest.approx(ap, abs=1e-12)


def test_best_threshold_first_max(spark):
    rows, df = _preds(spark)
    pts = []
    P = sum(y for _, y, _, _ in rows)
    for t in sorted({p for _, _, p, _ in rows}):
        tp = sum(1 for _, y, p, _ in rows if y == 1 and p >= t)
        fp = sum(1 for _, y, p, _ in rows if y == 0 and p >= t)
        pr, rc = tp / (tp + fp), tp / P
        pts.append((2 * pr * rc / (pr + rc + 1e-8), t))
    best = max(pts, key=lambda x: x[0])
    first = next(t for f, t in pts if f == best[0])
    r = EV.best_threshold(df).first()
    assert r["best_threshold"] == first and r["best_f1"] == pytest.approx(best[0])


def test_reference_confusion_matrix_metrics(spark):
    # counts of the reference's saved evaluation report
    rows = ([(0, 0)] * 963) + ([(0, 1)] * 72) + ([(1, 0)] * 16) + ([(1, 1)] * 358)
    df = spark.createDataFrame([(i, y, float(p), p) for i, (y, p) in enumerate(rows)],
                               "id long, label int, probability double, prediction int")
    m = EV.classification_metrics(df).first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (963, 72, 16, 358)
    assert round(m["accuracy"], 4) == 0.9375 and round(m["f1_score"], 4) == 0.8905
    assert round(m["precision"], 4) == 0.8326 and round(m["recall"], 4) == 0.9572
    rep = {r["class_name"]: r for r in EV.classification_report(df).collect()}
    assert rep["Not Churned"]["precision"] == pytest.approx(0.9836567926455567)
    assert rep["Churned"]["f1_score"] == pytest.approx(0.8905472636815921)
    assert rep["macro avg"]["recall"] == pytest.approx(0.943827016972797)
    assert rep["weighted avg"]["f1_score"] == pytest.approx(0.9388511289343889)
    assert rep["accuracy"]["f1_score"] == pytest.approx(0.9375443577004968)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(1, 0, 0.1, 0), (2, 1, 0.2, 0)], "id long, label int, probability double, prediction int")
    m = EV.classification_metrics(df).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1_score"] == 0.0


def test_cv_summary(spark):
    rows, df = _preds(spark, n=500)
    df = df.withColumn("fold", (F.col("id") % 5).cast("int"))
    r = EV.cv_summary(df).first()
    import numpy as np
    aucs = [_auc_pairs([x for x in rows if x[0] % 5 == k]) for k in range(5)]
    assert r["n_folds"] == 5
    assert r["cv_roc_auc_mean"] == pytest.approx(np.mean(aucs)) and r["cv_roc_auc_std"] == pytest.approx(np.std(aucs))


def test_auc_on_margins_with_score_range(spark):
    rows, df = _preds(spark)
    margins = df.withColumn("probability", (F.col("probability") - 0.5) * 40)  # scores in [-20, 20]
    a = EV.roc_auc(margins, score_range=(-20.0, 20.0)).first()["roc_auc"]
    b = EV.roc_auc(margins).first()["roc_auc"]  # clamped buckets: still exact
    assert a == pytest.approx(_auc_pairs(rows), abs=1e-12) and b == pytest.approx(a, abs=1e-12)


def test_curve_of_bunched_scores_equals_even_buckets(spark):
    rows = [(i % 3 == 0, 0.5 + i * 1e-12) for i in range(500)] + [(True, 0.0), (False, 1.0), (True, 1.0)]
    df = spark.createDataFrame([(int(y), s) for y, s in rows], "label int, probability double")
    a, b = EV.curve_summary(df).first().asDict(), EV.curve_summary(df, score_range=(0.0, 1.0)).first().asDict()
    assert a == pytest.approx(b)
    from ebbflow.operators.stats import quantile_bucket
    held = quantile_bucket(df, "probability", df).groupBy("_bucket").count()
    assert held.count() > 400  # even buckets hold the 500 in one
    assert EV.curve_summary(df.where("false")).count() <= 1
