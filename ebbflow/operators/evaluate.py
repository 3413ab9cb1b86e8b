"""E1-E10 evaluation operators on a predictions frame
(``label`` 0/1, ``probability`` in [0, 1], ``prediction`` 0/1).

Curve operators first aggregate to one row per distinct score (and group),
then cumulate with ``stats.prefix_sums`` (bucket totals + in-bucket windows),
so no step sorts all scores in one task. ``by`` evaluates many groups (models,
folds) in the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ebbflow.functions.scalar import round_half_up
from ebbflow.operators.stats import prefix_sums, quantile_bucket, score_bucket

# Fixed values that must equal the reference: the F1 epsilon of the best-threshold
# search, the fallback threshold, the class names of the report.
F1_EPS = 1e-8
DEFAULT_THRESHOLD = 0.5
CLASS_NAMES = {0: "Not Churned", 1: "Churned"}


def _score_table(preds: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    y = F.col(label).cast("long")
    return preds.groupBy(*by, score).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def _curve(preds: DataFrame, by: Sequence[str], score: str, label: str,
           score_range: tuple[float, float] | None = None) -> DataFrame:
    """One row per (group, distinct score) with the counts at and above it:
    ``tp``/``fp`` predict positive at score >= t; ``pos_before`` counts positives
    strictly above t. One parallel prefix pass feeds AUC, AP, F1 and the curve."""
    by = list(by)
    t = _score_table(preds, by, score, label)
    # class totals come from the small bucket-total table of the same pass
    if score_range is None:
        t = quantile_bucket(t, score, preds)
        bucket = F.col("_bucket").cast("int")
    else:
        bucket = score_bucket(score, lo=score_range[0], hi=score_range[1])
    c = prefix_sums(t, score, ["pos", "neg"], bucket, partition_cols=by, descending=True, totals=True)
    c = c.withColumnRenamed("pos_total", "_n_pos").withColumnRenamed("neg_total", "_n_neg")
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("neg_before") + F.col("neg")
    prec = tp.cast("double") / (tp + fp)
    rec = F.when(F.col("_n_pos") == 0, F.lit(1.0)).otherwise(tp.cast("double") / F.col("_n_pos"))
    c = c.select(*by, F.col(score).alias("threshold"), "pos", "neg", "pos_before", tp.alias("tp"), fp.alias("fp"),
                 prec.alias("precision"), rec.alias("recall"), F.col("_n_pos").alias("n_pos"),
                 F.col("_n_neg").alias("n_neg"))
    return c.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F1_EPS))


def curve_summary(preds: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
                  score_range: tuple[float, float] | None = None) -> DataFrame:
    """E1 + E7 + E8 in one aggregation over the curve rows:

    * ROC-AUC with half credit for ties = sum_t neg_t * (pos_above_t + pos_t / 2) / (P * N)
      (NULL when a class is absent);
    * AP = sum_t (R_t - R_prev) * P_t, where R_t - R_prev = pos_t / P;
    * best F1 threshold: first maximum in ascending threshold order (the end point
      only wins when there is no threshold, and then falls back to 0.5).

    The parallel prefix pass works on quantile buckets of the scores; a ``score_range``
    takes equal-width buckets instead, without the pass that finds the quantiles, for
    scores known to spread evenly (others stay exact, only clamped into the end buckets)."""
    by = list(by)
    c = _curve(preds, by, score, label, score_range)
    g = c.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2.0)),
                     F.first("n_pos").cast("double") * F.first("n_neg")).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.first("n_pos")).alias("avg_precision"),
        F.min(F.struct((-F.col("f1")).alias("neg_f1"), F.col("threshold"), F.col("precision"),
                       F.col("recall"))).alias("b"),
    )
    return g.select(*by, "roc_auc", "avg_precision",
                    F.coalesce(F.col("b.threshold"), F.lit(DEFAULT_THRESHOLD)).alias("best_threshold"),
                    F.coalesce(-F.col("b.neg_f1"), F.lit(0.0)).alias("best_f1"),
                    F.col("b.precision").alias("best_precision"), F.col("b.recall").alias("best_recall"))


def roc_auc(preds: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
            score_range: tuple[float, float] | None = None) -> DataFrame:
    """Exact ROC-AUC with half credit for tied scores."""
    return curve_summary(preds, by, score, label, score_range).select(*by, "roc_auc")


def confusion_counts(preds: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction") -> DataFrame:
    """TN, FP, FN, TP in one aggregation."""
    y, p = F.col(label), F.col(prediction)
    return preds.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def metrics_from_counts(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 of the positive class; a zero
    denominator gives 0 (the reference's zero_division behaviour)."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    return cm.select("*", F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                     prec.alias("precision"), rec.alias("recall"), f1.alias("f1_score"))


def classification_metrics(preds: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction") -> DataFrame:
    return metrics_from_counts(confusion_counts(preds, by, label, prediction))


def classification_report(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E5: per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    m = confusion_counts(preds, (), label, prediction)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def prf(t, f_p, f_n):
        p = F.coalesce(F.try_divide(t, t + f_p), F.lit(0.0))
        r = F.coalesce(F.try_divide(t, t + f_n), F.lit(0.0))
        f = F.coalesce(F.try_divide(2 * t, 2 * t + f_p + f_n), F.lit(0.0))
        return p, r, f

    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    row = m.select(p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
                   p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"), n.alias("n"),
                   F.try_divide(tp + tn, n).alias("acc"))
    c = F.col

    def rec(name, p, r, f, n):
        return F.struct(F.lit(name).alias("class_name"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"), n.alias("support"))

    none = F.lit(None).cast("double")
    rows = [
        rec(CLASS_NAMES[0], c("p0"), c("r0"), c("f0"), c("s0")),
        rec(CLASS_NAMES[1], c("p1"), c("r1"), c("f1"), c("s1")),
        rec("accuracy", none, none, c("acc"), c("n")),
        rec("macro avg", (c("p0") + c("p1")) / 2, (c("r0") + c("r1")) / 2, (c("f0") + c("f1")) / 2, c("n")),
        rec("weighted avg", F.try_divide(c("p0") * c("s0") + c("p1") * c("s1"), c("n")),
            F.try_divide(c("r0") * c("s0") + c("r1") * c("s1"), c("n")),
            F.try_divide(c("f0") * c("s0") + c("f1") * c("s1"), c("n")), c("n")),
    ]
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def pr_curve(preds: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label",
             end_point: bool = True) -> DataFrame:
    """Precision and recall for every distinct score t (predict positive when
    score >= t), ascending by threshold, plus the end point (precision 1,
    recall 0, no threshold). Carries the F1 of E8 and the per-threshold positives of E7."""
    by = list(by)
    curve = _curve(preds, by, score, label).select(*by, "threshold", "tp", "fp", "precision", "recall", "pos",
                                                   "n_pos", "f1")
    if not end_point:
        return curve
    ends = preds.groupBy(*by).agg(F.sum(F.col(label).cast("long")).alias("n_pos")).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("long").alias("tp"),
        F.lit(None).cast("long").alias("fp"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(0).cast("long").alias("pos"), "n_pos", F.lit(0.0).alias("f1"))
    return curve.unionByName(ends)


def threshold_sweep(preds: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label") -> DataFrame:
    """Precision / recall / F1 per threshold (E6 without the end point)."""
    return pr_curve(preds, by, score, label, end_point=False).select(*by, "threshold", "precision", "recall", "f1")


def average_precision(preds: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label") -> DataFrame:
    """AP = sum_n (R_n - R_{n-1}) P_n over thresholds in descending order."""
    return curve_summary(preds, by, score, label).select(*by, "avg_precision")


def best_threshold(preds: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "label") -> DataFrame:
    """Threshold of the first F1 maximum in ascending threshold order."""
    return curve_summary(preds, by, score, label).select(*by, "best_threshold", "best_f1", "best_precision",
                                                         "best_recall")


def evaluation_report(preds: DataFrame, digits: int = 4, label: str = "label") -> DataFrame:
    """The full one-row report (metrics rounded like the reference's JSON)."""
    cm = confusion_counts(preds, label=label).withColumn(
        "test_set_size", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).withColumn(
        "churn_rate", (F.col("fn") + F.col("tp")).cast("double") / F.col("test_set_size"))
    parts = [
        metrics_from_counts(cm),
        curve_summary(preds, label=label).select("roc_auc", "avg_precision", "best_threshold",
                                                 F.col("best_f1").alias("best_f1_threshold")),
    ]
    # one-row parts -> (metric, value) rows -> a single pivoted row; no joins needed
    long = None
    for p in parts:
        u = p.select(*[F.col(c).cast("double").alias(c) for c in p.columns]).unpivot([], p.columns, "metric", "value")
        long = u if long is None else long.unionByName(u)
    counts = ["test_set_size", "tn", "fp", "fn", "tp"]
    rounded = ["churn_rate", "roc_auc", "accuracy", "f1_score", "precision", "recall", "avg_precision",
               "best_threshold", "best_f1_threshold"]
    row = long.groupBy().pivot("metric", counts + rounded).agg(F.first("value"))
    return row.select(*[F.col(c).cast("long").alias(c) for c in counts],
                      *[round_half_up(c, digits).alias(c) for c in rounded])


def cv_summary(preds: DataFrame, fold: str = "fold", by: Sequence[str] = (), label: str = "label") -> DataFrame:
    """Per-fold ROC-AUC, then mean and population std over folds."""
    per = roc_auc(preds, by=[*by, fold], label=label)  # all folds (and models) in the same jobs
    return per.groupBy(*by).agg(F.count(F.lit(1)).alias("n_folds"), F.avg("roc_auc").alias("cv_roc_auc_mean"),
                                F.stddev_pop("roc_auc").alias("cv_roc_auc_std"))
