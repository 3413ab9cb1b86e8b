"""Streaming scoring equals batch scoring; sources and sinks."""

import os
import uuid

from pyspark.sql import functions as F

import __spark_entry__ as E
from ebbflow.session import ensure_checkpoint_dir
from ebbflow.sources import io

from conftest import SF_SMALL


def test_stream_equals_batch(spark):
    q = E.queries()
    s = q["stream_score"](spark, SF_SMALL)
    b = q["score_batch"](spark, SF_SMALL).drop("customer_index")
    rejected = q["stream_rejected"](spark, SF_SMALL)
    assert rejected.count() > 0 and rejected.where("violations = ''").count() == 0
    b = b.join(rejected, "customer_id", "left_anti")
    assert sorted(map(tuple, s.select(sorted(s.columns)).collect())) == \
        sorted(map(tuple, b.select(sorted(b.columns)).collect()))


def test_read_or_empty_and_json_roundtrip(spark):
    root = f"{ensure_checkpoint_dir(spark)}/io-{uuid.uuid4().hex}"
    empty = io.read_or_empty(spark, f"{root}/missing", "a int, b string")
    assert empty.count() == 0 and empty.columns == ["a", "b"]
    assert io.read_json_or_empty(spark, f"{root}/missing.json") == {}
    row = spark.createDataFrame([("Logistic Regression", 0.9916)], "best_model string, roc_auc double")
    io.write_json_row(row, f"{root}/info")
    assert io.read_json_or_empty(spark, f"{root}/info") == {"best_model": "Logistic Regression", "roc_auc": 0.9916}


def test_fallback_source(spark):
    schema = "customer_id long, total_charges string"
    good = lambda: spark.createDataFrame([(1, " ")], schema)
    bad = lambda: spark.read.parquet("/nonexistent/path/x.parquet")
    assert io.read_with_fallback(bad, good).count() == 1
    from pyspark.sql import types as T
    out = io.read_with_fallback(good, good, T.StructType([T.StructField("customer_id", T.StringType()),
                                                          T.StructField("extra", T.IntegerType())]))
    assert out.columns == ["customer_id", "extra"] and out.first()["extra"] is None


def test_csv_and_params_roundtrip(spark):
    from ebbflow.plans import churn
    root = f"{ensure_checkpoint_dir(spark)}/io-{uuid.uuid4().hex}"
    ft = churn.feature_table(spark, SF_SMALL)
    io.write_table(ft, f"{root}/features.csv", fmt="csv")
    back = io.read_csv(spark, f"{root}/features.csv", ft.schema)
    assert back.count() == ft.count()
    p = churn.feature_params(spark, SF_SMALL)
    io.save_params(spark, p, f"{root}/params")
    assert io.load_params(spark, f"{root}/params") == p


def test_append_and_empty_batch_gate(spark):
    from ebbflow.operators.quality import assert_not_empty
    root = f"{ensure_checkpoint_dir(spark)}/io-{uuid.uuid4().hex}"
    b = spark.createDataFrame([(1, 0.2)], "customer_id long, probability double")
    io.append_table(b, f"{root}/scored")
    io.append_table(b, f"{root}/scored")
    assert spark.read.parquet(f"{root}/scored").count() == 2
    import pytest
    with pytest.raises(ValueError):
        assert_not_empty(b.where("false"))
    assert_not_empty(b)


def test_api_fields_to_features(spark):
    from ebbflow import schemas as S
    from ebbflow.operators.scoring import from_api_fields
    api = {"Gender": 1, "Senior_Citizen": 0, "Partner": 1, "Dependents": 0, "Tenure_Months": 24, "Phone_Service": 1,
           "Multiple_Lines": 1, "Internet_Service": 1, "Online_Security": 0, "Online_Backup": 1, "Device_Protection": 0,
           "Tech_Support": 0, "Streaming_Tv": 1, "Streaming_Movies": 1, "Contract": 0, "Paperless_Billing": 1,
           "Payment_Method": 2, "Monthly_Charges": 85.5, "Total_Charges": 2052.0, "average_charges": 85.5,
           "high_value_customer": 1}
    df = spark.createDataFrame([tuple(api.values())], list(api))
    out = from_api_fields(df)
    assert out.columns == list(S.FEATURE_COLUMNS)
    r = out.first()
    assert r["support_ticket_count"] == 0 and r["tenure_months"] == 24 and r["payment_method"] == 2


def test_row_index_dense_and_empty(spark):
    from ebbflow.operators.scoring import row_index
    df = spark.createDataFrame([(k,) for k in [5, 100, 3, 7, 1000000, 42]], "id long")
    got = {r["id"]: r["customer_index"] for r in row_index(df, "id").collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}
    assert row_index(df.where("false"), "id").count() == 0
    texts = spark.createDataFrame([("C-2", 1), ("C-10", 1), ("C-2", 0), (None, 5)], "id string, n int")
    got = {(r["id"], r["n"]): r["customer_index"] for r in row_index(texts, ["id", "n"]).collect()}
    assert got == {(None, 5): 0, ("C-10", 1): 1, ("C-2", 0): 2, ("C-2", 1): 3}


def test_stream_rejects_a_row_without_fields(spark):
    """Nothing is imputed before the rules are applied."""
    from ebbflow import schemas as S
    from ebbflow.operators.scoring import BATCH_SCORER
    from ebbflow.plans import churn
    from ebbflow.streaming.score_stream import score_frame
    raw = churn.cleaned(spark, SF_SMALL)
    blank = raw.limit(1).select(S.KEY, *[F.lit(None).cast(f.dataType).alias(f.name) for f in raw.schema.fields if f.name != S.KEY])
    params = churn.feature_params(spark, SF_SMALL)
    for rows in (blank, blank.select(S.KEY)):
        r = score_frame(rows, params, BATCH_SCORER).first()
        assert not r["is_valid"] and "tenure_months: missing" in r["violations"] and "contract: below 0" in r["violations"]


def test_table_ddl_roundtrip(spark):
    from ebbflow import schemas as S
    from ebbflow.plans import churn
    root = f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"
    assert io.ddl("payments", S.PAYMENTS).startswith("CREATE TABLE IF NOT EXISTS payments (`payment_id` bigint NOT NULL, `customer_id` string")
    c, p, t = churn.source_tables(spark, SF_SMALL)
    io.write_table(io.conform(p, S.PAYMENTS), f"{root}/payments")
    spark.sql("DROP TABLE IF EXISTS payments")
    io.register_tables(spark, root, {"payments": S.PAYMENTS})
    assert spark.table("payments").count() == p.count()
    spark.sql("DROP TABLE IF EXISTS payments")


def test_cli_list_and_query(spark, capsys):
    from ebbflow.__main__ import main
    assert main(["list"]) == 0
    assert "feature_table" in capsys.readouterr().out.split()
    out = f"{ensure_checkpoint_dir(spark)}/cli-{uuid.uuid4().hex}"
    assert main(["query", "churn_kpis", "--sf", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).first()["total"] == 150


def test_long_running_stream_picks_up_new_files(spark):
    """Processing-time trigger: files landing while the query runs are scored once each."""
    from ebbflow import schemas as S
    from ebbflow.operators.scoring import BASELINE_SCORER
    from ebbflow.plans import churn
    from ebbflow.streaming.score_stream import start_scoring_stream
    root = f"{ensure_checkpoint_dir(spark)}/live-{uuid.uuid4().hex}"
    rows = churn.cleaned(spark, SF_SMALL)
    first, second = rows.where(F.col(S.KEY) % 2 == 0), rows.where(F.col(S.KEY) % 2 == 1)
    first.write.parquet(f"{root}/landing/part=0")
    q = start_scoring_stream(spark, f"{root}/landing", rows.schema, churn.feature_params(spark, SF_SMALL),
                             BASELINE_SCORER, f"{root}/scored", f"{root}/rejected", f"{root}/ckpt",
                             available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        second.write.parquet(f"{root}/landing/part=1")
        q.processAllAvailable()
    finally:
        q.stop()
    both = spark.read.parquet(f"{root}/scored").select(S.KEY).union(spark.read.parquet(f"{root}/rejected").select(S.KEY))
    assert both.count() == rows.count() and both.distinct().count() == rows.count()
