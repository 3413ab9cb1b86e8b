"""MLlib classifiers, grid search with fixed folds,
the model comparison table, ranking and best-model selection.

Every model is a ``Pipeline(VectorAssembler -> StandardScaler -> classifier)``
trained on the training split; the grid search is ``CrossValidator`` with the
split's stratified ``fold`` column (no random fold draw), scored by exact
ROC-AUC (``numBins=0``). Class weights are a ``weight`` column. The MLlib
learners differ from the reference's libraries (no RBF kernel, no leaf limit,
no solver choice); they match in role and grid, not in coefficients.

The comparison/ranking part works on any predictions frame tagged with a
``model`` column, so fixed scorers (checked against SQL) and MLlib models go
through the same grouped aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ebbflow import schemas as S
from ebbflow.functions.scalar import round_half_up
from ebbflow.operators import evaluate as EV
from ebbflow.session import at_once, materialize

# Fixed values that must equal the reference: the grids of the seven model
# families (C, trees, depth, min split, learning rate, subsample, neighbours).
LR_C = [0.01, 0.1, 1, 10]
RF_TREES, RF_DEPTH, RF_MIN_SPLIT = [100, 200], [4, 6, None], [2, 5]
GB_TREES, GB_RATE, GB_DEPTH = [100, 200], [0.05, 0.1], [3, 4]
XGB_TREES, XGB_RATE, XGB_DEPTH, XGB_SUBSAMPLE, XGB_POS_WEIGHT = [100, 200], [0.05, 0.1], [3, 4], [0.8, 1.0], 3
LGBM_TREES, LGBM_RATE, LGBM_DEPTH = [100, 200], [0.05, 0.1], [4, 6]
SVM_C = [0.1, 1, 10]
KNN_K, KNN_WEIGHTS, KNN_METRIC = [5, 7, 11], ["uniform", "distance"], ["euclidean", "manhattan"]
FAMILIES = ("Logistic Regression", "Random Forest", "Gradient Boosting", "XGBoost", "LightGBM", "SVM", "KNN")
SEED = 42
MAX_DEPTH_NONE = 30  # MLlib's depth limit stands in for "unlimited"


@dataclass
class FamilySpec:
    name: str
    estimator: object
    grid: list
    weighted: str | None  # None, "balanced" or "positive:<w>"


def _pipeline(clf, feature_cols: Sequence[str]):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(feature_cols), outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        clf,
    ])


def families(total_weight: float, feature_cols: Sequence[str] = S.FEATURE_COLUMNS,
             which: Sequence[str] | None = None) -> list[FamilySpec]:
    """The model families with their grids, translated to MLlib parameters.

    ``total_weight`` (sum of training weights) turns the reference's C into
    MLlib's regParam = 1 / (C * sum(w))."""
    from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
    from pyspark.ml.tuning import ParamGridBuilder

    out = []
    lr = LogisticRegression(labelCol="label", weightCol="weight", elasticNetParam=0.0, standardization=False,
                            maxIter=1000, tol=1e-6)
    out.append(FamilySpec("Logistic Regression", _pipeline(lr, feature_cols),
                          ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * total_weight) for c in LR_C]).build(),
                          "balanced"))
    rf = RandomForestClassifier(labelCol="label", weightCol="weight", seed=SEED)
    out.append(FamilySpec("Random Forest", _pipeline(rf, feature_cols),
                          ParamGridBuilder().addGrid(rf.numTrees, RF_TREES)
                          .addGrid(rf.maxDepth, [d if d is not None else MAX_DEPTH_NONE for d in RF_DEPTH])
                          .addGrid(rf.minInstancesPerNode, [max(1, m // 2) for m in RF_MIN_SPLIT]).build(), "balanced"))
    gb = GBTClassifier(labelCol="label", seed=SEED)
    out.append(FamilySpec("Gradient Boosting", _pipeline(gb, feature_cols),
                          ParamGridBuilder().addGrid(gb.maxIter, GB_TREES).addGrid(gb.stepSize, GB_RATE)
                          .addGrid(gb.maxDepth, GB_DEPTH).build(), None))
    xgb = GBTClassifier(labelCol="label", weightCol="weight", seed=SEED)
    out.append(FamilySpec("XGBoost", _pipeline(xgb, feature_cols),
                          ParamGridBuilder().addGrid(xgb.maxIter, XGB_TREES).addGrid(xgb.stepSize, XGB_RATE)
                          .addGrid(xgb.maxDepth, XGB_DEPTH).addGrid(xgb.subsamplingRate, XGB_SUBSAMPLE).build(),
                          f"positive:{XGB_POS_WEIGHT}"))
    lgbm = GBTClassifier(labelCol="label", weightCol="weight", seed=SEED)
    out.append(FamilySpec("LightGBM", _pipeline(lgbm, feature_cols),
                          ParamGridBuilder().addGrid(lgbm.maxIter, LGBM_TREES).addGrid(lgbm.stepSize, LGBM_RATE)
                          .addGrid(lgbm.maxDepth, LGBM_DEPTH).build(), "balanced"))
    # MLlib's default iteration cap: on the churn data 1,000 iterations picked the same
    # configuration with the same test AUC at ~15x the time
    svm = LinearSVC(labelCol="label", weightCol="weight", maxIter=100, standardization=False)
    out.append(FamilySpec("SVM", _pipeline(svm, feature_cols),
                          ParamGridBuilder().addGrid(svm.regParam, [1.0 / (c * total_weight) for c in SVM_C]).build(),
                          "balanced"))
    if which:
        out = [f for f in out if f.name in which]
    return out


def _weighted(train: DataFrame, how: str | None) -> DataFrame:
    from ebbflow.operators.split import with_weights
    if how is None:
        return train.withColumn("weight", F.lit(1.0))
    if how.startswith("positive:"):
        return with_weights(train, "label", positive_weight=float(how.split(":")[1]))
    return with_weights(train, "label")


def tune(train: DataFrame, spec: FamilySpec, parallelism: int = 4, n_folds: int = 5):
    """Grid search over the fixed folds, exact ROC-AUC, refit on all training rows."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)
    cv = CrossValidator(estimator=spec.estimator, estimatorParamMaps=spec.grid, evaluator=ev,
                        foldCol="fold", numFolds=n_folds, parallelism=parallelism, seed=SEED)
    return cv.fit(_weighted(train, spec.weighted))


def prepare(split_rows: DataFrame, feature_cols: Sequence[str] = S.FEATURE_COLUMNS) -> DataFrame:
    """Feature columns as double + ``label`` double; rows cached by the caller."""
    return split_rows.select(S.KEY, *[F.col(c).cast("double").alias(c) for c in feature_cols],
                             F.col(S.TARGET).cast("double").alias("label"), "split", "fold")


def best_params_text(cv_model) -> str:
    import numpy as np
    best = cv_model.getEstimatorParamMaps()[int(np.argmax(cv_model.avgMetrics))]
    return "{" + ", ".join(f"'{p.name}': {v}" for p, v in sorted(best.items(), key=lambda kv: kv[0].name)) + "}"


def fold_predictions(train: DataFrame, spec: FamilySpec, best_map, n_folds: int = 5, parallelism: int = 1) -> DataFrame:
    """Refit the best configuration on each k-1 folds and score the held-out fold
    (a margin model is calibrated on its own k-1 folds). Folds are fitted from
    ``parallelism`` driver threads, as ``CrossValidator`` does."""
    from concurrent.futures import ThreadPoolExecutor
    from ebbflow.operators.scoring import score_model
    est = spec.estimator.copy(best_map)
    weighted = _weighted(train, spec.weighted)

    def one(k: int) -> DataFrame:
        fit_rows = weighted.where(F.col("fold") != k)
        m = est.copy().fit(fit_rows)
        if needs_calibration(spec):
            m = calibrate(m, fit_rows)
        return score_model(weighted.where(F.col("fold") == k), m, label="label")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, range(n_folds)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- comparison, ranking, best marks -----------------------------------------------------------

METRICS = ["roc_auc", "accuracy", "f1_score", "precision", "recall"]


def comparison_table(test_preds: DataFrame, cv_preds: DataFrame | None = None, params: DataFrame | None = None,
                     digits: int = 4) -> DataFrame:
    """One row per ``model``: test metrics and CV mean/std, rounded like the
    reference's table. All models in the same grouped jobs."""
    calls = [lambda: EV.roc_auc(test_preds, by=["model"]), lambda: EV.classification_metrics(test_preds, by=["model"])]
    if cv_preds is not None:
        calls.append(lambda: EV.cv_summary(cv_preds, by=["model"]))
    auc, met, *summary = at_once(test_preds.sparkSession, calls)
    t = met.join(auc, "model")
    cols = [F.col("model"), *[round_half_up(m, digits).alias(m) for m in METRICS]]
    if cv_preds is not None:
        t = t.join(summary[0], "model", "left")
        cols += [round_half_up("cv_roc_auc_mean", digits).alias("cv_roc_auc_mean"),
                 round_half_up("cv_roc_auc_std", digits).alias("cv_roc_auc_std")]
    if params is not None:
        t = t.join(params, "model", "left")
        cols.append(F.col("best_params"))
    return t.select(*cols)


def rank_models(table: DataFrame) -> DataFrame:
    """O1: order by ROC-AUC then accuracy (both already rounded), name as the
    final tie-break, and number the rows from 0 (the re-index)."""
    w = Window.orderBy(F.desc("roc_auc"), F.desc("accuracy"), F.asc("model"))  # one row per model: tiny
    return table.withColumn("rank", F.row_number().over(w) - 1)


def best_model(table: DataFrame) -> DataFrame:
    """O2: the top-ranked row."""
    return table.orderBy(F.desc("roc_auc"), F.desc("accuracy"), F.asc("model")).limit(1)


def sort_by_metric(table: DataFrame, metric: str) -> DataFrame:
    """O3: ascending by a chosen metric (name breaks ties)."""
    return table.orderBy(F.asc(metric), F.asc("model"))


def best_marks(table: DataFrame, metrics: Sequence[str] = ("roc_auc", "accuracy", "f1_score")) -> DataFrame:
    """Per metric, flag the rows holding the column maximum."""
    w = Window.partitionBy()  # the comparison table has one row per model
    return table.select("model", *[(F.col(m) == F.max(m).over(w)).alias(f"{m}_is_best") for m in metrics])


def calibrate(model, train: DataFrame):
    """M10 probability for a margin classifier (LinearSVC): a one-feature logistic
    regression on the training margins (Platt scaling), as one pipeline with the model."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorSlicer
    svm = model.stages[-1].setRawPredictionCol("margins").setPredictionCol("margin_class")
    stages = [*model.stages[:-1], svm, VectorSlicer(inputCol="margins", outputCol="margin", indices=[1])]
    lr = LogisticRegression(featuresCol="margin", labelCol="label", regParam=0.0, maxIter=100)
    return PipelineModel([*stages, lr.fit(PipelineModel(stages).transform(train).select("margin", "label"))])


def needs_calibration(spec: FamilySpec) -> bool:
    return spec.name == "SVM"


def train_and_compare(split_rows: DataFrame, which: Sequence[str] | None = None, parallelism: int = 4,
                      n_folds: int = 5) -> tuple[DataFrame, dict]:
    """M12-M14 end to end: tune each family on the training folds, refit, score the
    test rows, re-run the folds for the CV mean/std, build and rank the table.
    Returns (ranked table, fitted models by name)."""
    from ebbflow.operators.scoring import score_model
    data = prepare(split_rows).persist()
    try:
        train = data.where(F.col("split") == "train")
        test = data.where(F.col("split") == "test")
        total_weight = float(train.count())  # balanced weights sum to n
        specs = families(total_weight, which=which)
        tests, cvs, params, fitted = [], [], [], {}
        spark = split_rows.sparkSession
        if which is None or "KNN" in which:
            kt, kcv, kbest, fitted["KNN"] = knn_family(split_rows)
            tests.append(kt.withColumn("model", F.lit("KNN")))
            cvs.append(kcv.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
                       .select("id", "label", "probability", "prediction", "fold").withColumn("model", F.lit("KNN")))
            params.append(("KNN", "{" + ", ".join(f"'{kv.split('=')[0]}': {kv.split('=')[1]}" for kv in kbest.split(",")) + "}"))
        for spec in specs:
            cvm = tune(train, spec, parallelism=parallelism, n_folds=n_folds)
            best = cvm.bestModel
            if needs_calibration(spec):
                best = calibrate(best, train)
            fitted[spec.name] = best
            tests.append(score_model(test, best, label="label").withColumn("model", F.lit(spec.name)))
            best_map = cvm.getEstimatorParamMaps()[max(range(len(cvm.avgMetrics)), key=lambda i: cvm.avgMetrics[i])]
            cvs.append(fold_predictions(train, spec, best_map, n_folds, parallelism).withColumn("model", F.lit(spec.name)))
            params.append((spec.name, best_params_text(cvm)))
        union = lambda xs: xs[0] if len(xs) == 1 else xs[0].unionByName(union(xs[1:]), allowMissingColumns=True)
        text_id = lambda df: df.withColumn("id", F.col("id").cast("string"))  # KNN's row ids are text
        # materialise the small per-model results before the training data is released
        test_preds = _materialise(union([text_id(t) for t in tests]))
        cv_preds = _materialise(union([text_id(c) for c in cvs])) if cvs else None
        ptab = spark.createDataFrame(params, "model string, best_params string")
        return rank_models(comparison_table(test_preds, cv_preds, ptab)), fitted
    finally:
        data.unpersist()


@dataclass
class KnnModel:
    """M11 as a fitted model: the standardised training rows, the scaling and the configuration."""

    train: DataFrame
    scale: list
    feature_cols: list
    k: int
    weights: str
    metric: str
    block_rows: int | None = None

    def predict(self, rows: DataFrame) -> DataFrame:
        """id (the row id), label (if present), probability and prediction of every row."""
        from ebbflow.operators.knn import neighbours, vote_proba
        vec = materialize(_vectors(rows, self.feature_cols, self.scale), "knn-queries")
        p = vote_proba(neighbours(self.train, vec, k=self.k, metric=self.metric, block_rows=self.block_rows), self.k, self.weights)
        keep = [c for c in ("label",) if c in vec.columns]
        return p.join(vec.select(F.col("vec_id").alias("qid"), *keep), "qid").select(
            F.col("qid").alias("id"), *keep, "probability", (F.col("probability") > 0.5).cast("int").alias("prediction"))

    def save(self, path: str) -> None:
        """The training rows as Parquet, the parameters as one JSON row beside them."""
        from ebbflow.sources.io import write_json_row
        self.train.write.mode("overwrite").parquet(f"{path}/train")
        row = (self.scale, self.feature_cols, self.k, self.weights, self.metric, self.block_rows)
        write_json_row(self.train.sparkSession.createDataFrame([row], KNN_PARAMS), f"{path}/params")

    @classmethod
    def load(cls, spark, path: str) -> "KnnModel":
        p = spark.read.schema(KNN_PARAMS).json(f"{path}/params").first()
        return cls(spark.read.parquet(f"{path}/train"), [tuple(x) for x in p["scale"]], list(p["feature_cols"]),
                   p["k"], p["weights"], p["metric"], p["block_rows"])


KNN_PARAMS = ("scale array<struct<mean: double, scale: double>>, feature_cols array<string>, k int, "
              "weights string, metric string, block_rows int")


def _vectors(rows: DataFrame, feature_cols: Sequence[str], scale) -> DataFrame:
    """vec_id (a digest of key and features: a customer may have several rows), embedding, and
    label, split and fold where present."""
    label = [F.col(c).cast("int").alias("label") for c in ("label", S.TARGET) if c in rows.columns][:1]
    return rows.select(
        F.md5(F.to_json(F.struct(S.KEY, *feature_cols))).alias("vec_id"),
        F.array(*[(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in zip(feature_cols, scale)]).alias("embedding"),
        *label, *[c for c in ("split", "fold") if c in rows.columns])


def knn_family(split_rows: DataFrame, feature_cols: Sequence[str] = S.FEATURE_COLUMNS, block_rows: int | None = None,
               **grid) -> tuple[DataFrame, DataFrame, str, KnnModel]:
    """M11 as a model family: features standardised on the training rows, the
    reference's grid scored by fold-wise ROC-AUC, the best configuration refit on
    all training rows and applied to the test rows.

    Returns (test predictions, per-fold CV predictions of the best config, best config, its model)."""
    from ebbflow.operators.knn import knn_grid_cv
    from ebbflow.operators.split import scaling
    train_rows = split_rows.where(F.col("split") == "train")
    scale = scaling(train_rows, list(feature_cols))
    train = materialize(_vectors(train_rows, feature_cols, scale), "knn-rows")  # every search reads it several times

    def model_of(config: str) -> KnnModel:
        cfg = dict(kv.split("=") for kv in config.split(","))
        return KnnModel(train.select("vec_id", "embedding", "label"), scale, list(feature_cols), int(cfg["k"]),
                        cfg["weights"], cfg["metric"], block_rows)

    test = lambda model: model.predict(split_rows.where(F.col("split") == "test"))
    search = lambda: _materialise(knn_grid_cv(train, block_rows=block_rows, **grid))
    only = [f"k={k},weights={w},metric={m}" for k in grid.get("ks", ()) for w in grid.get("weights", ()) for m in grid.get("metrics", ())]
    if len(only) == 1:  # the best one is known: its test rows are searched beside the folds
        cv, tested = at_once(train.sparkSession, [search, lambda: _materialise(test(model_of(only[0])))])
        best = only[0]
    else:
        cv = search()
        scores = EV.roc_auc(cv, by=["config", "fold"]).groupBy("config").agg(F.avg("roc_auc").alias("m"))
        best = scores.orderBy(F.desc("m"), F.asc("config")).first()["config"]
        tested = test(model_of(best))
    cv_best = cv.where(F.col("config") == best).select(F.col("qid").alias("id"), "label", "probability", "fold")
    return tested, cv_best, best, model_of(best)


def _materialise(df: DataFrame) -> DataFrame:
    """Write predictions once to the shared checkpoint folder (lineage cut, survives executor loss)."""
    from ebbflow.session import cut_lineage
    return cut_lineage(df)
