"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the mapped views) so its work
grows with them. Column names match the oracle SQL in ``plans.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbflow import schemas as S
from ebbflow.functions.scalar import map_with_default, round_half_up
from ebbflow.operators import explore as EX
from ebbflow.plans import churn

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@register
def features_base(spark, sf_dir):
    return churn.features_base(spark, sf_dir)


@register
def features_base_fanout(spark, sf_dir):
    return churn.features_base_fanout(spark, sf_dir)


@register
def feature_table(spark, sf_dir):
    return churn.feature_table(spark, sf_dir)


@register
def churn_by_contract(spark, sf_dir):
    """P12 + A4: churn rate per contract label (fitted code map, 'Unknown' default)."""
    ft = churn.feature_table(spark, sf_dir)
    codes = category_map(spark, sf_dir).where(F.col("column") == "contract").select(F.col("code").alias("_code"), "value")
    labelled = ft.join(codes, F.col("contract") == F.col("_code"), "left")
    return EX.rate_by_group(labelled.withColumn("contract_label", F.coalesce("value", F.lit("Unknown"))), "contract_label")


# --- S10/S11, P2, P4-P10: seeding and cleaning -------------------------------------------

@register
def build_customers(spark, sf_dir):
    from ebbflow.operators.cleaning import build_customers as op
    from ebbflow.sources.fixtures import raw_flat
    return op(raw_flat(spark, sf_dir))


@register
def build_payments(spark, sf_dir):
    from ebbflow.operators.cleaning import build_payments as op
    from ebbflow.sources.fixtures import raw_flat
    return op(raw_flat(spark, sf_dir))


@register
def drop_columns(spark, sf_dir):
    from ebbflow.operators.features import drop_columns as op
    return op(churn.features_base(spark, sf_dir))


@register
def coerce_numeric(spark, sf_dir):
    """P4 + P6 on text charges (blank strings), JSON-extracted event properties and malformed numbers."""
    from ebbflow.functions.scalar import coerce_int, coerce_numeric as num
    from ebbflow.sources import fixtures as FX
    from ebbflow.sources.tables import read_table
    pay = FX.payments(spark, sf_dir).select(
        F.lit("payments").alias("source"), F.col("customer_id").alias("row_id"),
        F.col("total_charges").alias("raw"))
    ev = read_table(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("row_id"),
        F.get_json_object("props", "$.k").alias("raw"))
    # malformed numbers, one of seven kinds per order
    odd = F.array(*map(F.lit, ("NaN", "Infinity", "-Infinity", "30000000000", " ", "x", "-7.9")))
    bad = read_table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("row_id"),
        F.get(odd, (F.col("o_orderkey") % 7).cast("int")).alias("raw"))
    both = pay.unionByName(ev).unionByName(bad)
    return both.select("source", "row_id", "raw", num("raw").alias("value"), coerce_int("raw").alias("value_int"))


@register
def clean_strings(spark, sf_dir):
    from ebbflow.operators.cleaning import clean_strings as op
    from ebbflow.sources.fixtures import raw_flat
    cols = ["customer_id", "gender", "contract", "payment_method", "partner"]
    return op(raw_flat(spark, sf_dir).select(*cols), cols)


@register
def average_charges(spark, sf_dir):
    """P7 + P8 on the coerced, not yet imputed rows (missing total stays missing)."""
    from ebbflow.operators.features import engineer, FeatureParams
    x = churn.cleaned(spark, sf_dir)
    return engineer(x, FeatureParams()).select(S.KEY, "tenure_months", "average_charges")


@register
def avg_charges_unguarded(spark, sf_dir):
    """P9 + A6: total / tenure with x/0 -> NULL, then median fill."""
    from ebbflow.functions.scalar import safe_ratio
    from ebbflow.operators.stats import percentiles
    x = churn.cleaned(spark, sf_dir).select(S.KEY, safe_ratio("total_charges", "tenure_months").alias("avg_charges"))
    med = percentiles(x, ["avg_charges"], [0.5])[((), "avg_charges")][0]
    return x.select(S.KEY, round_half_up(F.coalesce("avg_charges", F.lit(med)), 6).alias("avg_charges"))


@register
def high_value_flag(spark, sf_dir):
    """A7 + P10: flag above the 75th percentile of the imputed monthly charges."""
    p = churn.feature_params(spark, sf_dir)
    ft = churn.feature_table(spark, sf_dir)
    return ft.select(S.KEY, "monthly_charges", "high_value_customer",
                     round_half_up(F.lit(p.high_value_threshold), 6).alias("threshold"))


@register
def encode_binary(spark, sf_dir):
    """F1 + F2 on the cleaned rows (before imputation): unmapped or missing -> NULL."""
    from ebbflow.functions.scalar import map_values
    from ebbflow.operators.features import BINARY_MAP, GENDER_MAP
    x = churn.cleaned(spark, sf_dir)
    return x.select(S.KEY, map_values("gender", GENDER_MAP, "int").alias("gender"),
                    *[map_values(c, BINARY_MAP, "int").alias(c) for c in S.BINARY_COLUMNS])


@register
def encode_categories(spark, sf_dir):
    """F3 apply on the cleaned rows: a missing value gets -1."""
    from ebbflow.operators.features import encode, FeatureParams
    p = churn.feature_params(spark, sf_dir)
    only_codes = FeatureParams(categories=p.categories, category_tables=p.category_tables)
    x = churn.cleaned(spark, sf_dir).select(S.KEY, *S.CATEGORICAL_COLUMNS)
    return encode(x, only_codes)


@register
def category_map(spark, sf_dir):
    from ebbflow.operators.features import category_map as op
    return op(churn.feature_params(spark, sf_dir), spark)


@register
def feature_metadata(spark, sf_dir):
    """F4, flattened: list columns joined with ',' (the nested form is ``features.feature_metadata``)."""
    from ebbflow.operators.features import feature_metadata as op
    m = op(churn.feature_params(spark, sf_dir), spark)
    return m.select(
        F.array_join("feature_columns", ",").alias("feature_columns"), "target_column",
        F.array_join("numerical_cols", ",").alias("numerical_cols"),
        F.array_join("engineered_cols", ",").alias("engineered_cols"),
        "n_rows", "n_features",
        (F.size(F.map_keys("encoding_map")) + F.size(F.map_keys("code_tables"))).alias("n_encoded_columns"),
    )


@register
def impute_median(spark, sf_dir):
    from ebbflow.operators.features import impute, FeatureParams
    p = churn.feature_params(spark, sf_dir)
    x = impute(churn.cleaned(spark, sf_dir), FeatureParams(medians=p.medians))
    return x.select(S.KEY, *[round_half_up(c, 6).alias(c) for c in S.NUMERICAL_COLUMNS])


@register
def impute_mode(spark, sf_dir):
    from ebbflow.operators.features import impute, FeatureParams
    p = churn.feature_params(spark, sf_dir)
    x = impute(churn.cleaned(spark, sf_dir), FeatureParams(modes=p.modes))
    return x.select(S.KEY, *S.BINARY_COLUMNS, *S.CATEGORICAL_COLUMNS)


@register
def encode_for_scoring(spark, sf_dir):
    """raw labelled rows (flat text export, no ticket history -> 0 tickets)
    encoded with the parameters fitted on the training tables."""
    from ebbflow.operators.cleaning import build_customers as bc
    from ebbflow.operators.features import encode_raw
    from ebbflow.functions.scalar import clean_string
    from ebbflow.sources.fixtures import raw_flat
    flat = raw_flat(spark, sf_dir)
    cust = bc(flat).withColumn(S.KEY, F.col(S.KEY).cast("long"))
    bill = flat.select(clean_string(S.KEY).cast("long").alias(S.KEY), clean_string("paperless_billing").alias("paperless_billing"),
                       clean_string("payment_method").alias("payment_method"),
                       F.col("monthly_charges").try_cast("double").alias("monthly_charges"), "total_charges")
    rows = cust.join(bill, S.KEY).withColumn("support_ticket_count", F.lit(0).cast("long"))
    out = encode_raw(rows, churn.feature_params(spark, sf_dir))
    return out.select(*[round_half_up(c, 6).alias(c) if c in ("monthly_charges", "total_charges", "tenure_months") else c
                        for c in out.columns])


# --- A2, Q1-Q7, A10: data quality --------------------------------------------------------

# Fixed values that must equal the reference: minimum rows per source table (Q1).
MIN_ROWS = {"customers": 1000, "payments": 1000, "support_tickets": 1000}


def _tables(spark, sf_dir):
    c, p, t = churn.source_tables(spark, sf_dir)
    return {"customers": c, "payments": p, "support_tickets": t}


@register
def table_counts(spark, sf_dir):
    from ebbflow.operators.quality import table_counts as op
    return op(_tables(spark, sf_dir))


@register
def min_row_gate(spark, sf_dir):
    from ebbflow.operators.quality import min_row_gate as op
    return op(_tables(spark, sf_dir), MIN_ROWS)


@register
def pk_duplicates(spark, sf_dir):
    """Q4 on the keys of the three tables, and on documents by their text (copies exist)."""
    from ebbflow.operators.quality import pk_duplicates as op
    from ebbflow.sources.tables import read_table
    t = _tables(spark, sf_dir)
    texts = read_table(spark, sf_dir, "documents").select(F.md5("text").alias("text_md5"))
    return op({"customers": (t["customers"], "customer_id"), "payments": (t["payments"], "payment_id"),
               "support_tickets": (t["support_tickets"], "ticket_id"), "documents": (texts, "text_md5")})


@register
def fk_orphans(spark, sf_dir):
    """Payments and tickets without a customer, and documents without a label."""
    from ebbflow.operators.quality import fk_orphans as op
    from ebbflow.sources.tables import read_table
    t = _tables(spark, sf_dir)
    children = op(t["customers"], {"payments": (t["payments"], "payment_id"),
                                   "support_tickets": (t["support_tickets"], "ticket_id")})
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return children.unionByName(op(read_table(spark, sf_dir, "labels"), {"documents": (docs, "doc_id")}, key="doc_id"))


@register
def valid_children(spark, sf_dir):
    """The documents that have a label."""
    from ebbflow.operators.join import valid_children as op
    from ebbflow.sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return op(docs, read_table(spark, sf_dir, "labels"), "doc_id")


@register
def null_counts(spark, sf_dir):
    from ebbflow.operators.quality import null_counts as op
    return op(churn.cleaned(spark, sf_dir))


@register
def validate_inputs(spark, sf_dir):
    """Q3 on un-imputed scoring rows (missing and -1 codes break rules)."""
    from ebbflow.operators.features import encode_strict
    from ebbflow.operators.quality import scoring_rules, validate
    rows = encode_strict(churn.cleaned(spark, sf_dir), churn.feature_params(spark, sf_dir))
    v = validate(rows, scoring_rules(S.FEATURE_COLUMNS))
    return v.select(S.KEY, "is_valid", F.size("violations").alias("n_violations"),
                    F.array_join("violations", ";").alias("violations"))


@register
def dominant_columns(spark, sf_dir):
    from ebbflow.operators.quality import dominant_columns as op
    return op(EX.value_counts(churn.cleaned(spark, sf_dir), S.BINARY_COLUMNS + S.CATEGORICAL_COLUMNS + ["gender"]))


# --- A3-A17, P18, P19: KPIs and exploration ----------------------------------------------

NUMERIC_FOR_CORR = ["tenure_months", "monthly_charges", "total_charges", "average_charges", "churn_value"]


def _r6(df, skip=()):
    return df.select(*[round_half_up(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" and f.name not in skip
                       else F.col(f.name) for f in df.schema.fields])


@register
def churn_kpis(spark, sf_dir):
    return EX.kpis(churn.feature_table(spark, sf_dir))


@register
def churn_by_value_tier(spark, sf_dir):
    ft = churn.feature_table(spark, sf_dir)
    lab = map_with_default("high_value_customer", {0: "Standard", 1: "High Value"}, "Unknown")
    return EX.rate_by_group(ft.withColumn("tier", lab), "tier")


@register
def value_counts(spark, sf_dir):
    return EX.value_counts(churn.cleaned(spark, sf_dir), ["gender"] + S.BINARY_COLUMNS + S.CATEGORICAL_COLUMNS)


@register
def correlation_matrix(spark, sf_dir):
    return EX.correlation_matrix(churn.feature_table(spark, sf_dir), NUMERIC_FOR_CORR)


@register
def hist_tenure(spark, sf_dir):
    return _r6(EX.histogram(churn.feature_table(spark, sf_dir), "tenure_months"))


@register
def hist_monthly(spark, sf_dir):
    return _r6(EX.histogram(churn.feature_table(spark, sf_dir), "monthly_charges"))


@register
def box_tenure(spark, sf_dir):
    return _r6(EX.box_stats(churn.feature_table(spark, sf_dir), "tenure_months"))


@register
def box_by_order(spark, sf_dir):
    """A13 with as many groups as orders, one of them the NULL group."""
    from ebbflow.sources.tables import read_table
    items = read_table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 50 != 0, F.col("l_orderkey")).alias("order_id"), "l_extendedprice")
    return _r6(EX.box_stats(items, "l_extendedprice", by="order_id"))


@register
def box_average_charges(spark, sf_dir):
    return _r6(EX.box_stats(churn.feature_table(spark, sf_dir), "average_charges"))


@register
def mean_ci_by_class(spark, sf_dir):
    return _r6(EX.mean_ci(churn.feature_table(spark, sf_dir), "monthly_charges"))


@register
def density_curve(spark, sf_dir):
    d = EX.density_curve(churn.feature_table(spark, sf_dir), "average_charges")
    fine = F.round(F.col("density").cast("decimal(38,18)"), 12).cast("double")  # a density per unit of money is small
    return _r6(d.withColumn("density", fine), skip=("density",))


@register
def bootstrap_ci_by_class(spark, sf_dir):
    """A14 as the reference draws it: the bootstrapped mean's interval, 200 replicates."""
    return _r6(EX.bootstrap_mean_ci(churn.feature_table(spark, sf_dir), "monthly_charges", S.KEY))


@register
def scatter_sample(spark, sf_dir):
    """Raw points of the scatter plot, 100 a class, with their weight."""
    return _r6(EX.point_sample(churn.feature_table(spark, sf_dir), "average_charges", "monthly_charges", S.KEY))


@register
def pair_bins(spark, sf_dir):
    return EX.pair_bins(churn.feature_table(spark, sf_dir), "tenure_months", "monthly_charges")


@register
def churn_share(spark, sf_dir):
    ft = churn.feature_table(spark, sf_dir)
    lab = map_with_default(S.TARGET, {0: "Retained", 1: "Churned"}, "Unknown")
    return EX.share_of_total(ft.withColumn("churn_label", lab), "churn_label")


@register
def preview_rows(spark, sf_dir):
    return EX.preview(churn.feature_table(spark, sf_dir), S.KEY, 20)


@register
def profile_columns(spark, sf_dir):
    return EX.profile(churn.feature_table(spark, sf_dir))


# --- M1-M4: split, folds, scaling, weights -----------------------------------------------

@register
def stratified_split(spark, sf_dir):
    return churn.split_table(spark, sf_dir).select(S.KEY, S.TARGET, "split")


@register
def fold_assign(spark, sf_dir):
    return churn.split_table(spark, sf_dir).where(F.col("split") == "train").select(S.KEY, S.TARGET, "fold")


@register
def standardize(spark, sf_dir):
    from ebbflow.operators.split import standardize as op
    st = churn.split_table(spark, sf_dir)
    z = op(st, S.FEATURE_COLUMNS, fit_on=F.col("split") == "train")
    return z.select(S.KEY, *[round_half_up(F.col(c).cast("double"), 6).alias(c) for c in S.FEATURE_COLUMNS])


@register
def class_weights(spark, sf_dir):
    from ebbflow.operators.split import class_weights as op
    return _r6(op(churn.split_table(spark, sf_dir).where(F.col("split") == "train")))


@register
def logistic_coefficients(spark, sf_dir):
    """M5: the published configuration (C = 10, balanced weights) on all training rows, by Newton steps."""
    from ebbflow.operators import compare, linear
    blocks = linear.blocks_of(compare.rows_of(churn.split_table(spark, sf_dir), S.FEATURE_COLUMNS), S.FEATURE_COLUMNS)
    fit, = linear.make_fits([("logistic", 10.0)], [None], blocks, len(S.FEATURE_COLUMNS))
    linear.newton(blocks, [fit])
    rows = spark.createDataFrame([(n, float(b)) for n, b in zip([*S.FEATURE_COLUMNS, "intercept"], fit.beta)], "feature string, coefficient double")
    return _r6(rows)


# --- E1-E10, M13: evaluation -------------------------------------------------------------

def _test_preds(spark, sf_dir):
    return churn.predictions(spark, sf_dir)


@register
def roc_auc(spark, sf_dir):
    from ebbflow.operators.evaluate import roc_auc as op
    return _r6(op(_test_preds(spark, sf_dir)))


@register
def classification_metrics(spark, sf_dir):
    from ebbflow.operators.evaluate import classification_metrics as op
    return _r6(op(_test_preds(spark, sf_dir)))


@register
def confusion_matrix(spark, sf_dir):
    from ebbflow.operators.evaluate import confusion_counts as op
    return op(_test_preds(spark, sf_dir))


@register
def classification_report(spark, sf_dir):
    from ebbflow.operators.evaluate import classification_report as op
    return _r6(op(_test_preds(spark, sf_dir)))


@register
def pr_curve(spark, sf_dir):
    from ebbflow.operators.evaluate import pr_curve as op
    return _r6(op(_test_preds(spark, sf_dir)).select("threshold", "tp", "fp", "precision", "recall", "f1"))


@register
def average_precision(spark, sf_dir):
    from ebbflow.operators.evaluate import average_precision as op
    return _r6(op(_test_preds(spark, sf_dir)))


@register
def best_threshold(spark, sf_dir):
    from ebbflow.operators.evaluate import best_threshold as op
    return _r6(op(_test_preds(spark, sf_dir)))


@register
def threshold_sweep(spark, sf_dir):
    from ebbflow.operators.evaluate import threshold_sweep as op
    return _r6(op(_test_preds(spark, sf_dir)))


@register
def evaluation_report(spark, sf_dir):
    from ebbflow.operators.evaluate import evaluation_report as op
    return op(_test_preds(spark, sf_dir))


@register
def cv_scores(spark, sf_dir):
    """M13 for the fixed scorer: per-fold AUC on the training folds, mean and std."""
    from ebbflow.operators.evaluate import cv_summary
    return _r6(cv_summary(churn.predictions(spark, sf_dir, split="train")))


# --- M15, P13-P15, P20, U1, A19: scoring -------------------------------------------------

def _scored(spark, sf_dir):
    from ebbflow.operators.scoring import row_index, score_records
    return score_records(row_index(churn.scored_rows(spark, sf_dir), "id"))


@register
def score_batch(spark, sf_dir):
    return _scored(spark, sf_dir).select(F.col("id").alias(S.KEY), "customer_index", "churn_prediction",
                                         "churn_probability", "churn_risk_level", "message")


@register
def risk_bands(spark, sf_dir):
    from ebbflow.functions.scalar import risk_level, risk_message
    preds = churn.scored_rows(spark, sf_dir)
    return preds.select(F.col("id").alias(S.KEY), round_half_up("probability", 6).alias("probability"), risk_level("probability").alias("churn_risk_level"),
                        risk_message("prediction", batch=False).alias("message"))


@register
def batch_summary(spark, sf_dir):
    from ebbflow.operators.scoring import batch_summary as op
    return op(churn.scored_rows(spark, sf_dir))


def _billing_key():
    return [S.KEY, "monthly_charges", "total_charges", "payment_method", "paperless_billing"]


@register
def split_multi_billing(spark, sf_dir):
    """M1/M2 by customer: text keys and several billing rows per customer."""
    from ebbflow.operators.split import split_assign
    return split_assign(churn.multi_billing_features(spark, sf_dir)).select(
        *_billing_key(), "support_ticket_count", S.TARGET, "split", "fold")


@register
def score_multi_billing(spark, sf_dir):
    """M15/P20 over text keys and several billing rows per customer."""
    from ebbflow.operators.scoring import BATCH_SCORER, row_index, score_records
    rows = churn.multi_billing_features(spark, sf_dir)
    p = BATCH_SCORER.probability()
    preds = rows.select(*_billing_key(), p.alias("probability"), (p > 0.5).cast("int").alias("prediction"))
    return score_records(row_index(preds, _billing_key())).select(
        S.KEY, "monthly_charges", "customer_index", "churn_prediction", "churn_probability", "churn_risk_level", "message")


@register
def concat_batches(spark, sf_dir):
    """Rows with a known contract code and rows without one arrive as two batches."""
    from ebbflow.operators.scoring import concat_batches as op
    ft = churn.feature_table(spark, sf_dir)
    codes = category_map(spark, sf_dir).where(F.col("column") == "contract").select(F.col("code").alias("contract"))
    return op([ft.join(codes, "contract", "left_semi").withColumn("batch", F.col("contract")),
               ft.join(codes, "contract", "left_anti").withColumn("batch", F.lit(-1))]).select(
        S.KEY, "batch", "contract", S.TARGET)


# --- M11, M13-M14, O1-O3, A18, A20, T1: models, ranking, run summary, stream ------------

@register
def knn_vote(spark, sf_dir):
    """M11 (k=11, 1/distance weights, euclidean) on the embeddings' test split."""
    return _r6(churn.knn_predictions(spark, sf_dir, k=11, weights="distance", metric="euclidean"))


def _comparison(spark, sf_dir):
    from ebbflow.operators.models import comparison_table, rank_models as rank
    test = churn.all_model_predictions(spark, sf_dir, "test")
    cv = churn.all_model_predictions(spark, sf_dir, "train")
    return rank(comparison_table(test, cv))


@register
def rank_models(spark, sf_dir):
    """M14 + O1 over the fixed scorers: test metrics, 5-fold CV mean/std, ranked."""
    return _comparison(spark, sf_dir)


@register
def best_model(spark, sf_dir):
    from ebbflow.operators.models import best_model as op
    return op(_comparison(spark, sf_dir).drop("rank"))


@register
def sort_by_metric(spark, sf_dir):
    """O3: the comparison table in ascending accuracy, with each row's position."""
    from ebbflow.operators.models import sort_by_metric as op
    rows = op(_comparison(spark, sf_dir).select("model", "roc_auc", "accuracy"), "accuracy").collect()  # one per model
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "position int, model string, roc_auc double, accuracy double")


@register
def best_marks(spark, sf_dir):
    from ebbflow.operators.models import best_marks as op
    return op(_comparison(spark, sf_dir))


@register
def run_summary(spark, sf_dir):
    """Per-step statuses of one monthly run, derived from the step outputs."""
    from ebbflow.plans.run import run_summary as op
    return op(spark, sf_dir)


@register
def stream_score(spark, sf_dir):
    """All customers' raw rows land as files; a Structured Streaming query checks them
    and scores the valid ones (equal to score_batch on those)."""
    from ebbflow.plans.run import stream_score as op
    return op(spark, sf_dir)


@register
def stream_rejected(spark, sf_dir):
    """The rows that the stream rejects, with the rules they break."""
    from ebbflow.plans.run import stream_rejected as op
    return op(spark, sf_dir)


@register
def model_input(spark, sf_dir):
    """The feature columns that models read, in model order, with label, split and fold."""
    from ebbflow.operators.models import prepare
    return _r6(prepare(churn.split_table(spark, sf_dir)))


@register
def saved_model_scores(spark, sf_dir):
    """The logistic model fitted, saved, loaded, and applied to the test rows."""
    import uuid
    from ebbflow.operators import compare, linear
    from ebbflow.session import ensure_checkpoint_dir
    split, cols = churn.split_table(spark, sf_dir), list(S.FEATURE_COLUMNS)
    blocks = linear.blocks_of(compare.rows_of(split, cols), cols)
    fit, = linear.make_fits([("logistic", 10.0)], [None], blocks, len(cols))
    linear.newton(blocks, [fit])
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    linear.LinearModel(cols, fit).save(spark, path)
    rows = linear.LinearModel.load(spark, path).predict(split.where(F.col("split") == "test"), S.KEY)
    return _r6(rows.select(F.col("id").alias(S.KEY), "probability", "prediction"))


@register
def dated_features(spark, sf_dir):
    """The feature table written under its run date (the last event's day) and read back."""
    import uuid
    from ebbflow.session import ensure_checkpoint_dir
    from ebbflow.sources import io
    from ebbflow.sources.tables import read_table
    day = read_table(spark, sf_dir, "events").agg(F.to_date(F.max("ts"))).first()[0]
    path = f"{ensure_checkpoint_dir(spark)}/features-{uuid.uuid4().hex}"
    io.write_table(churn.feature_table(spark, sf_dir).withColumn("run_date", F.lit(day)), path, partition_by=["run_date"])
    return spark.read.parquet(path).where(F.col("run_date") == F.lit(day)).select(S.KEY, S.TARGET, "run_date")


@register
def batch_gate(spark, sf_dir):
    """Q6: the tickets of each severity as a batch, and a batch without rows, which is refused."""
    from ebbflow.operators.quality import assert_not_empty
    tickets, out = _tables(spark, sf_dir)["support_tickets"], []
    for severity in ("Low", "Medium", "High", "Urgent"):
        batch = tickets.where(F.col("severity") == severity)
        try:
            assert_not_empty(batch)
            out.append((severity, batch.count(), "accepted"))
        except ValueError as e:
            out.append((severity, 0, str(e)))
    return spark.createDataFrame(out, "severity string, n_rows long, status string")


@register
def train_models(spark, sf_dir):
    """All seven families at their published best configurations, on five folds and on all
    training rows, scored on the test rows and ranked."""
    from ebbflow.operators.compare import compare
    return compare(churn.split_table(spark, sf_dir))[0]


@register
def label_evaluation(spark, sf_dir):
    """E1/E7 grouped: a document-length score evaluated against the second binary
    targets (``labels.quality``, ``labels.toxic``) per language, all groups in the same jobs."""
    from ebbflow.operators.evaluate import curve_summary
    from ebbflow.sources.tables import read_table
    lab = read_table(spark, sf_dir, "labels").unpivot("doc_id", ["quality", "toxic"], "target", "label")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    preds = lab.join(docs, "doc_id").select(
        "target", "lang", F.col("label").cast("int").alias("label"),
        round_half_up(F.col("n_chars") / (F.col("n_chars") + 2000.0), 12).alias("probability"))
    by = ["target", "lang"]
    counts = preds.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("n_pos"))
    out = counts.join(curve_summary(preds, by=by).select(*by, "roc_auc", "avg_precision"), by)
    return _r6(out)


from ebbflow.plans import connectors  # noqa: E402,F401 - registers the queries over sources and sinks
