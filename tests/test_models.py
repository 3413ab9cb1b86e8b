"""MLlib families on a small split: grid search over the fixed folds, refit,
comparison table, ranking, persistence."""

import uuid

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import models as M
from ebbflow.plans import churn
from ebbflow.session import ensure_checkpoint_dir

from conftest import SF_SMALL


def test_rank_and_best_on_reference_table(spark):
    # the reference's saved comparison values must come out in the reference's order
    rows = [("Logistic Regression", 0.9916, 0.9375, 0.8905), ("XGBoost", 0.9913, 0.9368, 0.8897),
            ("Gradient Boosting", 0.9912, 0.9503, 0.9041), ("SVM", 0.9912, 0.9326, 0.8837),
            ("LightGBM", 0.9908, 0.9375, 0.8908), ("Random Forest", 0.9892, 0.9503, 0.9084), ("KNN", 0.9534, 0.8999, 0.8066)]
    t = spark.createDataFrame(rows[::-1], "model string, roc_auc double, accuracy double, f1_score double")
    ranked = [r["model"] for r in M.rank_models(t).orderBy("rank").collect()]
    assert ranked == [r[0] for r in rows]
    assert M.best_model(t).first()["model"] == "Logistic Regression"
    assert [r["model"] for r in M.sort_by_metric(t, "f1_score").collect()][:2] == ["KNN", "SVM"]
    marks = {r["model"]: r for r in M.best_marks(t).collect()}
    assert marks["Logistic Regression"]["roc_auc_is_best"] and marks["Random Forest"]["f1_score_is_best"]
    assert marks["Gradient Boosting"]["accuracy_is_best"] and marks["Random Forest"]["accuracy_is_best"]


def test_logistic_family_end_to_end(spark):
    st = churn.split_table(spark, SF_SMALL)
    table, fitted = M.train_and_compare(st, which=["Logistic Regression"], parallelism=2)
    r = table.first()
    assert r["model"] == "Logistic Regression" and r["rank"] == 0
    assert 0.0 <= r["roc_auc"] <= 1.0 and r["cv_roc_auc_mean"] is not None and "regParam" in r["best_params"]
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    from ebbflow.sources import io
    io.save_model(fitted["Logistic Regression"], path)
    assert io.load_pipeline(path) is not None


def test_tree_and_margin_families_fit(spark):
    from ebbflow.operators.scoring import score_model
    st = M.prepare(churn.split_table(spark, SF_SMALL))
    train = st.where(F.col("split") == "train")
    specs = {s.name: s for s in M.families(float(train.count()))}
    rf = specs["Random Forest"]
    model = rf.estimator.copy(rf.grid[0]).fit(M._weighted(train, rf.weighted))
    assert score_model(train, model, label="label").count() == train.count()
    svm = specs["SVM"]
    est = svm.estimator.copy(svm.grid[0])
    est.getStages()[-1].setMaxIter(20)
    cal = M.calibrate(est.fit(M._weighted(train, svm.weighted)), train)
    p = score_model(train, cal, label="label").agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0
    from ebbflow.sources import io
    path = f"{ensure_checkpoint_dir(spark)}/svm-{uuid.uuid4().hex}"
    io.save_model(cal, path)
    a, b = (sorted(map(tuple, score_model(st, m, label="label").select("id", "probability").collect()))
            for m in (cal, io.load_pipeline(path)))
    assert a == b and len(a) == st.count()


def test_knn_family_on_features(spark):
    st = churn.split_table(spark, SF_SMALL)
    test_preds, cv_best, best, model = M.knn_family(st, ks=(3, 5), weights=("uniform", "distance"), metrics=("euclidean",),
                                             block_rows=64)
    n_test = st.where(F.col("split") == "test").count()
    assert test_preds.count() == n_test
    assert cv_best.select("fold").distinct().count() == 5
    assert best.startswith("k=") and "metric=euclidean" in best
    r = test_preds.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0
    path = f"{ensure_checkpoint_dir(spark)}/knn-{uuid.uuid4().hex}"
    model.save(path)
    again = M.KnnModel.load(spark, path).predict(st.where(F.col("split") == "test"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, test_preds.collect()))
    table = M.rank_models(M.comparison_table(test_preds.withColumn("model", F.lit("KNN")),
                                             cv_best.withColumn("model", F.lit("KNN"))))
    assert table.first()["model"] == "KNN"


def test_monthly_run_writes_every_output(spark):
    from ebbflow.plans.run import monthly_run
    from ebbflow.sources import io
    out = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    with pytest.raises(ValueError):  # sf0.001 has fewer than 1,000 customers: the gate aborts the run
        monthly_run(spark, SF_SMALL, out)
    paths = monthly_run(spark, "/root/testdata/sf0.01", out, families=("Logistic Regression",), run_date="2026-12-01")
    assert spark.read.parquet(paths["features"]).where("run_date = DATE'2026-12-01'").count() == 1500
    assert io.read_json_or_empty(spark, paths["metadata"])["n_features"] == 22
    assert io.read_json_or_empty(spark, paths["best_model_info"])["best_model"] == "Logistic Regression"
    rep = io.read_json_or_empty(spark, paths["evaluation_report"])
    assert rep["test_set_size"] == 300 and rep["tn"] + rep["fp"] + rep["fn"] + rep["tp"] == 300
    assert io.load_pipeline(paths["model"]) is not None


def test_boosted_families_fit(spark):
    from ebbflow.operators.scoring import score_model
    st = M.prepare(churn.split_table(spark, SF_SMALL))
    train = st.where(F.col("split") == "train")
    for spec in M.families(float(train.count()), which=["Gradient Boosting", "XGBoost", "LightGBM"]):
        est = spec.estimator.copy(spec.grid[0])
        est.getStages()[-1].setMaxIter(3)
        p = score_model(train, est.fit(M._weighted(train, spec.weighted)), label="label")
        low, high, n = p.agg(F.min("probability"), F.max("probability"), F.count("*")).first()
        assert 0.0 <= low < high <= 1.0 and n == train.count()


def test_svm_family_end_to_end(spark):
    st = churn.split_table(spark, SF_SMALL)
    table, fitted = M.train_and_compare(st, which=["SVM"], parallelism=8)
    r = table.first()
    assert r["model"] == "SVM" and r["cv_roc_auc_mean"] is not None and "regParam" in r["best_params"]
    assert hasattr(fitted["SVM"], "write")
