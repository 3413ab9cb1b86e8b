"""Run-level plans: the monthly run summary (A20) and the streaming scoring job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbflow import schemas as S
from ebbflow.plans import churn
from ebbflow.session import ensure_checkpoint_dir

STEP_OK = ("success", "passed")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: run date, the four step statuses, best model and its metrics, and the
    overall status. A step without a status counts as failed (the reference skips it)."""
    from ebbflow.plans.catalog import MIN_ROWS, _comparison, _tables
    from ebbflow.operators.evaluate import evaluation_report
    from ebbflow.operators.quality import min_row_gate
    from ebbflow.sources.tables import read_table

    gate = min_row_gate(_tables(spark, sf_dir), MIN_ROWS).agg(
        F.when(F.min(F.col("ok").cast("int")) == 1, "passed").otherwise("failed").alias("validation"))
    ft = churn.feature_table(spark, sf_dir)
    nulls = F.lit(0)
    for c in ft.columns:
        nulls = nulls + F.count_if(F.col(c).isNull())
    fe = ft.agg(F.when((F.count(F.lit(1)) > 0) & (nulls == 0), "success").otherwise("failed").alias("feature_engineering"))
    best = _comparison(spark, sf_dir).where(F.col("rank") == 0).select(
        F.col("model").alias("best_model"), "roc_auc", "accuracy")
    tr = best.agg(F.when(F.count("roc_auc") > 0, "success").otherwise("failed").alias("model_training"),
                  F.first("best_model").alias("best_model"), F.first("roc_auc").alias("roc_auc"),
                  F.first("accuracy").alias("accuracy"))
    ev = evaluation_report(churn.predictions(spark, sf_dir)).select(
        F.when(F.col("test_set_size") > 0, "success").otherwise("failed").alias("model_evaluation"))
    run_date = read_table(spark, sf_dir, "events").agg(F.to_date(F.max("ts")).alias("run_date"))
    # each part is a one-row aggregate: stack them as (key, value) rows and pivot back
    parts = [run_date, gate, fe, tr, ev]
    long = None
    for p in parts:
        u = p.select(*[F.col(c).cast("string").alias(c) for c in p.columns]).unpivot([], p.columns, "k", "v")
        long = u if long is None else long.unionByName(u)
    keys = ["run_date", "validation", "feature_engineering", "model_training", "model_evaluation",
            "best_model", "roc_auc", "accuracy"]
    row = long.groupBy().pivot("k", keys).agg(F.first("v"))
    statuses = [F.col(c) for c in ("validation", "feature_engineering", "model_training", "model_evaluation")]
    ok = None
    for s in statuses:
        c = F.coalesce(s.isin(*STEP_OK), F.lit(False))
        ok = c if ok is None else ok & c
    return row.select(F.col("run_date").cast("date").alias("run_date"),
                      "validation", "feature_engineering", "model_training", "model_evaluation", "best_model",
                      F.col("roc_auc").cast("double").alias("roc_auc"), F.col("accuracy").cast("double").alias("accuracy"),
                      F.when(ok, "SUCCESS").otherwise("PARTIAL FAILURE").alias("overall_status"))


def _scoring_stream(spark: SparkSession, sf_dir: str) -> str:
    """Run the scoring stream over all customers' raw rows, once per run and input; the folder of its sinks."""
    key = churn._key(spark, sf_dir, "stream")
    if key in churn._TABLES:
        return churn._TABLES[key]
    from ebbflow.operators.scoring import BATCH_SCORER
    from ebbflow.streaming.score_stream import start_scoring_stream
    root = f"{ensure_checkpoint_dir(spark)}/ebbflow-stream-{uuid.uuid4().hex}"
    params = churn.feature_params(spark, sf_dir)
    # arrivals: as many files as the input has partitions
    churn.cleaned(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/landing")
    schema = spark.read.parquet(f"{root}/landing").schema
    q = start_scoring_stream(spark, f"{root}/landing", schema, params, BATCH_SCORER,
                             f"{root}/scored", f"{root}/rejected", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    churn._TABLES[key] = root
    return root


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_scoring_stream(spark, sf_dir)}/scored").select(
        S.KEY, "churn_prediction", "churn_probability", "churn_risk_level", "message")


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_scoring_stream(spark, sf_dir)}/rejected").select(S.KEY, "violations")


def monthly_run(spark: SparkSession, sf_dir: str, out_dir: str, families=None,
                run_date: str | None = None) -> dict:
    """The monthly job as one Spark application: Q1 gate -> F6 feature
    table (S4) + metadata (S6) -> M12-M14 tuning and ranking (comparison table,
    best model S8, best-model info S6) -> E10 report of the best model on the test
    rows (S6) -> A20 summary. Every output is a Spark write under ``out_dir``.
    ``families`` defaults to all seven. Returns the output paths."""
    from ebbflow.operators.evaluate import evaluation_report
    from ebbflow.operators.features import feature_metadata
    from ebbflow.operators.models import FAMILIES, prepare, train_and_compare
    from ebbflow.operators.quality import assert_gate, min_row_gate
    from ebbflow.operators.scoring import score_model
    from ebbflow.plans.catalog import MIN_ROWS, _tables
    from ebbflow.sources import io

    paths = {k: f"{out_dir}/{k}" for k in ("features", "metadata", "comparison", "model", "best_model_info",
                                             "evaluation_report", "run_summary")}
    assert_gate(min_row_gate(_tables(spark, sf_dir), MIN_ROWS))                      # Q1: abort early
    ft = churn.feature_table(spark, sf_dir)
    stamp = F.lit(run_date).cast("date") if run_date else F.current_date()
    io.write_table(ft.withColumn("run_date", stamp), paths["features"], partition_by=["run_date"])   # S4
    io.write_json_row(feature_metadata(churn.feature_params(spark, sf_dir), spark), paths["metadata"])  # S6
    split = churn.split_table(spark, sf_dir)
    table, fitted = train_and_compare(split, which=list(families or FAMILIES),
                                      parallelism=max(1, min(8, spark.sparkContext.defaultParallelism)))
    table = table.persist()
    try:
        io.write_table(table, paths["comparison"], fmt="csv")
        best = table.where(F.col("rank") == 0).first()
        io.write_json_row(table.where(F.col("rank") == 0).drop("rank").withColumnRenamed("model", "best_model"),
                          paths["best_model_info"])
        name = best["model"]
        if name == "KNN":
            fitted[name].save(paths["model"])                                      # S8
            preds = fitted[name].predict(split.where(F.col("split") == "test"))
        else:
            io.save_model(fitted[name], paths["model"])                            # S8
            preds = score_model(prepare(split).where(F.col("split") == "test"), fitted[name], label="label")
        report = evaluation_report(preds).withColumn("best_model", F.lit(name))
        io.write_json_row(report, paths["evaluation_report"])
        io.write_json_row(run_summary(spark, sf_dir), paths["run_summary"])
    finally:
        table.unpersist()
    return paths
