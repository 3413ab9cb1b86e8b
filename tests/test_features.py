"""J1 fan-out semantics, fit/transform and encoding."""

from pyspark.sql import functions as F

from ebbflow.operators import features as FE
from ebbflow.operators.join import features_base


def _tables(spark):
    cust = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "customer_id long, name string")
    pay = spark.createDataFrame([
        (1, "Yes", "Mailed check", 10.0, "10"), (1, "Yes", "Mailed check", 10.0, "10"),  # two identical rows
        (3, "No", "Credit card (automatic)", 5.0, " "),
    ], "customer_id long, paperless_billing string, payment_method string, monthly_charges double, total_charges string")
    tick = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, None), (14, 9)], "ticket_id long, customer_id long")
    return cust, pay, tick


def test_fanout_counts(spark):
    cust, pay, tick = _tables(spark)
    rows = {r["customer_id"]: r for r in features_base(cust, pay, tick).collect()}
    assert rows[1]["support_ticket_count"] == 4          # two identical payments x two tickets
    assert rows[2]["support_ticket_count"] == 1          # no payments, one ticket
    assert rows[2]["monthly_charges"] is None
    assert rows[3]["support_ticket_count"] == 0
    assert len(rows) == 3


def test_fanout_matches_naive_join(spark):
    cust, pay, tick = _tables(spark)
    naive = (cust.join(pay, "customer_id", "left").join(tick, "customer_id", "left")
             .groupBy("customer_id", "name", "monthly_charges", "total_charges", "payment_method", "paperless_billing")
             .agg(F.count("ticket_id").alias("support_ticket_count")))
    ours = features_base(cust, pay, tick)
    assert sorted(map(tuple, naive.select(sorted(naive.columns)).collect()), key=str) == \
        sorted(map(tuple, ours.select(sorted(ours.columns)).collect()), key=str)


def _frame(spark):
    rows = [
        (1, "Female", 0, "Yes", "No", 0.0, "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No",
         "Month-to-month", 20.0, None, "Mailed check", "Yes", 1, 0),
        (2, "Male", 1, None, "Yes", 10.0, "Yes", "Yes", "Fiber optic", "Yes", "Yes", "Yes", "Yes", "Yes", "Yes",
         None, 80.0, 800.0, "Electronic check", "No", 3, 1),
        (3, "Male", 0, "No", "No", 5.0, "No", "No phone service", "No", "No internet service", "No internet service",
         "No internet service", "No internet service", "No internet service", "No internet service",
         "Two year", 50.0, 250.0, "Mailed check", "No", 0, 0),
        (4, "Female", 0, "Yes", "No", 8.0, "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No",
         "Two year", 40.0, 1.0, "Bank transfer (automatic)", "Yes", 2, 1),
    ]
    cols = ("customer_id long, gender string, senior_citizen int, partner string, dependents string, tenure_months double, "
            "phone_service string, multiple_lines string, internet_service string, online_security string, "
            "online_backup string, device_protection string, tech_support string, streaming_tv string, "
            "streaming_movies string, contract string, monthly_charges double, total_charges double, "
            "payment_method string, paperless_billing string, support_ticket_count long, churn_value int")
    return spark.createDataFrame(rows, cols)


def test_fit_transform(spark):
    df = _frame(spark)
    p = FE.fit(df)
    assert p.medians["total_charges"] == 250.0
    assert p.modes["partner"] == "Yes" and p.modes["contract"] == "Two year"
    assert p.categories["contract"] == ["Month-to-month", "Two year"]
    assert p.high_value_threshold == 57.5          # percentile .75 of 20, 40, 50, 80
    out = {r["customer_id"]: r for r in FE.transform(df, p).collect()}
    assert out[1]["total_charges"] == 250.0 and out[1]["average_charges"] == 20.0   # tenure 0 -> monthly
    assert out[2]["partner"] == 1 and out[2]["contract"] == 1                        # imputed by modes
    assert out[2]["high_value_customer"] == 1 and out[3]["high_value_customer"] == 0
    assert out[3]["multiple_lines"] == 1 and out[3]["online_security"] == 0
    assert out[4]["average_charges"] == 0.12                                         # 1/8 = 0.125 -> half to even
    assert list(FE.transform(df, p).columns)[1:-1] == list(FE.S.FEATURE_COLUMNS)


def test_unmapped_codes(spark):
    df = _frame(spark)
    p = FE.fit(df)
    other = df.withColumn("contract", F.lit("Three year")).withColumn("partner", F.lit("Perhaps"))
    r = FE.encode(other, p).first()
    assert r["contract"] == -1 and r["partner"] is None


def test_params_roundtrip(spark):
    p = FE.fit(_frame(spark))
    assert FE.FeatureParams.from_json(p.to_json()) == p


def test_high_cardinality_codes_by_join(spark, monkeypatch):
    monkeypatch.setattr(FE, "CATEGORY_LITERAL_LIMIT", 1)
    df = _frame(spark)
    p = FE.fit(df)
    assert p.categories["payment_method"] is None and "payment_method" in p.category_tables
    out = {r["customer_id"]: r["payment_method"] for r in FE.encode(df, p).collect()}
    assert out == {1: 2, 2: 1, 3: 2, 4: 0}
    codes = {(r["column"], r["code"]): r["value"] for r in FE.category_map(p, spark).collect()}
    assert [codes[("payment_method", i)] for i in range(3)] == sorted(v for (c, _), v in codes.items() if c == "payment_method")
    meta = FE.feature_metadata(p, spark).first()
    assert set(meta["code_tables"]) | set(meta["encoding_map"]) >= {"payment_method", "contract"}
    from ebbflow.session import ensure_checkpoint_dir
    from ebbflow.sources import io
    path = f"{ensure_checkpoint_dir(spark)}/params-many-codes"
    io.save_params(spark, p, path)
    loaded = io.load_params(spark, path)
    assert loaded.category_tables["payment_method"].startswith(path)
    assert {r["customer_id"]: r["payment_method"] for r in FE.encode(df, loaded).collect()} == out


def test_code_table_order_matches_sorted(spark):
    from ebbflow.operators import stats
    vals = ["b", "a", "ab", "Ä", "é", "", "a b", "zz", "Z", "ä", "aa", "a"]
    df = spark.createDataFrame([(v,) for v in vals], "contract string")
    counts = stats.value_count_table(df, ["contract"])
    path = FE._write_code_table(counts, "contract")
    got = {r["value"]: r["code"] for r in spark.read.parquet(path).collect()}
    want = {v: i for i, v in enumerate(sorted(set(vals)))}
    assert got == want


def test_hot_customer_skew(spark):
    """One customer holds a third of all tickets and thousands of distinct payment
    rows: counts stay exact and tickets are reduced before the shuffle."""
    n_cust, hot_pay, n_tick = 200, 3000, 30000
    cust = spark.range(n_cust).select(F.col("id").alias("customer_id"), F.lit("x").alias("name"))
    pay = spark.range(hot_pay + n_cust).select(
        F.when(F.col("id") < hot_pay, F.lit(0)).otherwise(F.col("id") - hot_pay).cast("long").alias("customer_id"),
        F.lit("Yes").alias("paperless_billing"), F.lit("Mailed check").alias("payment_method"),
        F.when(F.col("id") < hot_pay, F.col("id") + 1000.0).otherwise(F.lit(1.0)).alias("monthly_charges"),
        F.lit("1").alias("total_charges"))
    tick = spark.range(n_tick).select(F.col("id").alias("ticket_id"),
                                      F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % n_cust).cast("long")
                                      .alias("customer_id"))
    out = features_base(cust, pay, tick)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    hot = out.where("customer_id = 0")
    n_hot_tickets = tick.where("customer_id = 0").count()
    assert hot.count() == hot_pay + 1  # 3000 distinct rows + the customer's own (1.0) row
    assert {r[0] for r in hot.select("support_ticket_count").distinct().collect()} == {n_hot_tickets}
    others = {r["customer_id"]: r["support_ticket_count"] for r in out.where("customer_id > 0").collect()}
    per = {r["customer_id"]: r["count"] for r in tick.groupBy("customer_id").count().collect()}
    assert all(others[c] == per.get(c, 0) for c in range(1, n_cust))


def test_fit_rank_selection_path_equals_direct(spark):
    df = _frame(spark)
    assert FE.fit(df, distinct_limit=0) == FE.fit(df)


def test_rank_selection_on_real_tables(spark):
    from ebbflow.plans import churn
    base = churn.cleaned(spark, "/root/testdata/sf0.01")
    assert FE.fit(base, distinct_limit=50, persist=False) == FE.fit(base, persist=False)
    from ebbflow.operators import stats
    cols, probs = ["monthly_charges", "total_charges", "tenure_months"], [0.25, 0.5, 0.75]
    assert stats.percentiles(base, cols, probs, distinct_limit=0, final_limit=200) == stats.percentiles(base, cols, probs)


def test_join_strategies_agree(spark):
    from ebbflow.plans import churn
    c, p, t = churn.source_tables(spark, "/root/testdata/sf0.01")
    a = features_base(c, p, t)
    b = features_base(c, p, t, hash_build_customers=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fit_approx_opt_in(spark):
    p = FE.fit(_frame(spark), approx=True)
    assert p.medians["total_charges"] in (250.0, 800.0, 1.0) and p.modes["contract"] == "Two year"
