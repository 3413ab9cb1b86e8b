"""All seven model families in shared passes over packed rows.

The tree families (``trees``) grow together, the linear ones (``linear``) take their Newton
steps together, KNN searches its index (``knn``) beside them. Every configuration is a fit on each fold and
is scored on the fold it left out by exact ROC-AUC; the best of a family is fitted on all
training rows and scored on the test rows. With one configuration a family, its fit on all rows
joins the first passes.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbflow import schemas as S
from ebbflow.operators import evaluate as EV, linear as L, models as M, trees as T
from ebbflow.session import at_once, dealt, materialize

N_FOLDS = 5

# Fixed values that must equal the reference: the published best configuration of each family.
PUBLISHED = {
    "Logistic Regression": [{"C": 10}],
    "XGBoost": [{"learning_rate": 0.05, "max_depth": 3, "n_estimators": 200, "subsample": 0.8}],
    "Gradient Boosting": [{"learning_rate": 0.05, "max_depth": 4, "n_estimators": 100}],
    "SVM": [{"C": 10}],
    "LightGBM": [{"learning_rate": 0.05, "max_depth": 6, "n_estimators": 100, "num_leaves": 31}],
    "Random Forest": [{"max_depth": None, "min_samples_split": 5, "n_estimators": 100}],
    "KNN": [{"metric": "euclidean", "n_neighbors": 11, "weights": "distance"}],
}
LGBM_LEAVES = [31, 50]


def grid(**values) -> list[dict]:
    return [dict(zip(values, x)) for x in itertools.product(*values.values())]


def full_grid() -> dict[str, list[dict]]:
    """The reference's whole grids."""
    return {
        "Logistic Regression": grid(C=M.LR_C),
        "XGBoost": grid(learning_rate=M.XGB_RATE, max_depth=M.XGB_DEPTH, n_estimators=M.XGB_TREES, subsample=M.XGB_SUBSAMPLE),
        "Gradient Boosting": grid(learning_rate=M.GB_RATE, max_depth=M.GB_DEPTH, n_estimators=M.GB_TREES),
        "SVM": grid(C=M.SVM_C),
        "LightGBM": grid(learning_rate=M.LGBM_RATE, max_depth=M.LGBM_DEPTH, n_estimators=M.LGBM_TREES, num_leaves=LGBM_LEAVES),
        "Random Forest": grid(max_depth=M.RF_DEPTH, min_samples_split=M.RF_MIN_SPLIT, n_estimators=M.RF_TREES),
        "KNN": grid(metric=M.KNN_METRIC, n_neighbors=M.KNN_K, weights=M.KNN_WEIGHTS),
    }


def tree_spec(family: str, p: dict, n_features: int) -> T.TreeSpec:
    """A configuration as the family's library reads it, its defaults included."""
    if family == "Random Forest":
        return T.TreeSpec(family, p["n_estimators"], depth=p["max_depth"], forest=True, min_split=p["min_samples_split"], weights="balanced",
                          max_features=max(1, int(n_features**0.5)))
    boost = {"trees": p["n_estimators"], "rate": p["learning_rate"], "depth": p["max_depth"]}
    if family == "XGBoost":
        return T.TreeSpec(family, **boost, l2=1.0, min_hessian=1.0, subsample=p["subsample"], weights=float(M.XGB_POS_WEIGHT), from_prior=False)
    if family == "LightGBM":
        return T.TreeSpec(family, **boost, leaves=p["num_leaves"], min_rows=20, min_hessian=1e-3, weights="balanced")
    return T.TreeSpec(family, **boost, by_hessian=False)


TREES, LINEAR = ("Random Forest", "Gradient Boosting", "XGBoost", "LightGBM"), {"Logistic Regression": "logistic", "SVM": "hinge"}


def rows_of(split_rows: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Packed-row input: id (a digest of key and features, as a customer may have several rows)."""
    return split_rows.select(F.md5(F.to_json(F.struct(S.KEY, *feature_cols))).alias("id"), F.col(S.TARGET).alias("label"),
                             F.when(F.col("split") == "train", F.col("fold")).alias("fold"), *feature_cols)


def params_text(p: dict) -> str:
    return "{" + ", ".join(f"'{k}': {v}" for k, v in sorted(p.items())) + "}"


def _best(scored: DataFrame, configs: dict[int, tuple[str, dict]]) -> dict[str, dict]:
    """The configuration of each family with the largest mean AUC over the folds (the first of equal ones)."""
    auc = EV.roc_auc(scored, by=["config", "fold"]).groupBy("config").agg(F.avg("roc_auc").alias("auc"))
    mean = {r["config"]: r["auc"] for r in auc.collect()}  # one row a configuration
    out: dict[str, dict] = {}
    for k, (family, p) in configs.items():
        if family not in out or (mean.get(k) or 0) > out[family]["auc"]:
            out[family] = {"auc": mean.get(k) or 0, "config": k, "params": p}
    return out


def _family_fits(make, run, predict, configs: dict[int, tuple[str, dict]], finish=None):
    """Fit every configuration on every fold and the best of each family on all rows. ``make`` gives
    the fits of (configuration, fold) pairs, ``run`` fits them, ``finish`` calibrates. Returns the
    held-out and the test predictions tagged by model, the best parameters and the final fits."""
    families = {f for f, _ in configs.values()}
    single = len(families) == len(configs)
    folds = list(range(N_FOLDS))
    fits = make(configs, folds + [None] * single)
    run([f for fs in fits.values() for f in fs])
    if finish:
        for k, fs in fits.items():
            finish(configs[k][0], [f for f in fs if f.fold is not None], next((f for f in fs if f.fold is None), None))
    number = {f.number: k for k, fs in fits.items() for f in fs}
    config = F.element_at(F.create_map(*[x for n, k in number.items() for x in (F.lit(n), F.lit(k))]), F.col("fit"))
    held = predict([f for fs in fits.values() for f in fs if f.fold is not None]).withColumn("config", config)
    held = materialize(held.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), "held-out")
    best = _best(held, configs)
    final = {}
    if not single:
        again = make({b["config"]: configs[b["config"]] for b in best.values()}, [None])
        run([f for fs in again.values() for f in fs])
        if finish:
            for k, (f,) in again.items():
                finish(configs[k][0], [x for x in fits[k]], f)
    for family, b in best.items():
        final[family] = next(f for f in (fits if single else again)[b["config"]] if f.fold is None)
    tests = predict(list(final.values()))
    name = F.element_at(F.create_map(*[x for fam, f in final.items() for x in (F.lit(f.number), F.lit(fam))]), F.col("fit"))
    tests = tests.withColumn("model", name).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    chosen = F.create_map(*[x for fam, b in best.items() for x in (F.lit(b["config"]), F.lit(fam))])
    held = held.withColumn("model", F.try_element_at(chosen, F.col("config"))).where(F.col("model").isNotNull())
    columns = ["id", "label", "probability", "prediction", "model"]
    return held.select(*columns, "fold"), tests.select(*columns), {fam: b["params"] for fam, b in best.items()}, final


def compare(split_rows: DataFrame, configs: dict[str, list[dict]] | None = None,
            feature_cols: Sequence[str] = S.FEATURE_COLUMNS) -> tuple[DataFrame, dict]:
    """The ranked comparison table (M14, O1) of the given families' configurations (the published
    ones by default), and the fitted models by name."""
    configs = configs or PUBLISHED
    spark, cols = split_rows.sparkSession, list(feature_cols)
    split_rows = dealt(split_rows, "compared")
    rows = rows_of(split_rows, cols)

    def trees(numbered):
        cuts = T.cuts_of(rows.where(F.col("fold").isNotNull()), cols)
        blocks = T.blocks_of(rows, cols, cuts).persist()
        widths = [len(c) + 1 for c in cuts]

        def make(chosen, folds):
            fits = T.prepare_fits([tree_spec(fam, p, len(cols)) for fam, p in chosen.values()], folds, blocks)
            return {k: fits[i * len(folds):(i + 1) * len(folds)] for i, k in enumerate(chosen)}

        cv, test, best, final = _family_fits(make, lambda fits: T.grow(blocks, widths, fits), lambda fits: T.predictions(blocks, fits), numbered)
        test = materialize(test, "tree-tests")
        blocks.unpersist()
        return cv, test, best, {fam: T.TreeModel(cols, cuts, f) for fam, f in final.items()}

    def linear(numbered):
        dense = L.blocks_of(rows, cols).persist()

        def make_linear(chosen, folds):
            fits = L.make_fits([(LINEAR[fam], float(p["C"])) for fam, p in chosen.values()], folds, dense, len(cols))
            return {k: fits[i * len(folds):(i + 1) * len(folds)] for i, k in enumerate(chosen)}

        def finish(family, folds, final):
            if LINEAR[family] == "hinge":
                L.cross_fit(dense, folds, final)

        cv, test, best, final = _family_fits(make_linear, lambda fits: L.newton(dense, fits), lambda fits: L.predictions(dense, fits), numbered, finish)
        test = materialize(test, "linear-tests")
        dense.unpersist()
        return cv, test, best, {fam: L.LinearModel(cols, f) for fam, f in final.items()}

    def knn(chosen):
        each = lambda n: tuple(dict.fromkeys(p[n] for p in chosen))
        test, cv, best, model = M.knn_family(split_rows, cols, ks=each("n_neighbors"), weights=each("weights"), metrics=each("metric"))
        tag = lambda df, *more: df.withColumn("prediction", (F.col("probability") > 0.5).cast("int")).select(
            F.col("id").cast("string").alias("id"), "label", "probability", "prediction", F.lit("KNN").alias("model"), *more)
        found = dict(x.split("=") for x in best.split(","))
        return tag(cv, "fold"), materialize(tag(test), "knn-tests"), {"KNN": {
            "metric": found["metric"], "n_neighbors": int(found["k"]), "weights": found["weights"]}}, {"KNN": model}

    numbered = lambda families: dict(enumerate((fam, p) for fam in families for p in configs.get(fam, [])))
    fitted = lambda *kinds: [kind(chosen) for kind, chosen in kinds if chosen]
    found = at_once(spark, [lambda: fitted((trees, numbered(TREES)), (linear, numbered(LINEAR))), lambda: fitted((knn, configs.get("KNN")))])
    cvs, tests, best, final = zip(*itertools.chain(*found))
    params, models = ({fam: x for found in several for fam, x in found.items()} for several in (best, final))

    union = lambda xs: xs[0] if len(xs) == 1 else xs[0].unionByName(union(xs[1:]))
    told = spark.createDataFrame([(fam, params_text(p)) for fam, p in params.items()], "model string, best_params string")
    return M.rank_models(M.comparison_table(union(tests), union(cvs), told)), models
