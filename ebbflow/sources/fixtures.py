"""Mapped source tables built from the driver's TPC-H-like tables.

The reference reads ``customers``, ``payments`` and ``support_tickets`` from a
database. Here they are derived, lazily and column-pruned, from ``customer``,
``orders`` and ``events`` by fixed rules (FIXTURES.md §2 plus the same style of
rule for the remaining columns). Every rule is a plain column expression, so
the mapping runs in the same stage as the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbflow.sources.tables import read_table

CHURN_CUTOFF = "2000-06-01 00:00:00"


def _internet_addon(nation: Column, cond: Column) -> Column:
    return F.when(nation % 3 == 0, F.lit("No internet service")).when(cond, "Yes").otherwise("No")


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregation over orders per customer: the last order date (target) and
    the fields of the first order (smallest key, the billing row). Both mapped
    tables use this same plan, so Spark computes its shuffle once and reuses it."""
    o = read_table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_order"),
        F.min_by(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"), F.col("o_orderkey")).alias("first"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    last = _orders_by_customer(spark, sf_dir).select("o_custkey", "last_order")
    key, nat, bal, seg = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    no_phone = key % 10 == 7
    return (
        c.join(last, c.c_custkey == last.o_custkey, "left")
        .select(
            key.alias("customer_id"),
            F.concat(F.lit("City "), nat.cast("string")).alias("city"),
            (F.lit(90000) + key % 1000).cast("int").alias("zip_code"),
            (F.lit(30.0) + nat * 0.5).cast("double").alias("latitude"),
            (F.lit(-120.0) + nat * 0.25).cast("double").alias("longitude"),
            F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.when(nat % 5 == 0, 1).otherwise(0).cast("int").alias("senior_citizen"),
            F.when(key % 97 == 0, F.lit(None).cast("string"))
            .when(bal < 3000, "No").otherwise("Yes").alias("partner"),
            F.when(key % 4 == 0, "Yes").otherwise("No").alias("dependents"),
            (key % 73).cast("int").alias("tenure_months"),
            F.when(no_phone, "No").otherwise("Yes").alias("phone_service"),
            F.when(no_phone, "No phone service").when(key % 3 == 0, "Yes").otherwise("No")
            .alias("multiple_lines"),
            F.when(nat % 3 == 0, "No").when(nat % 3 == 1, "DSL").otherwise("Fiber optic")
            .alias("internet_service"),
            _internet_addon(nat, bal >= 5000).alias("online_security"),
            _internet_addon(nat, key % 2 == 0).alias("online_backup"),
            _internet_addon(nat, key % 5 < 2).alias("device_protection"),
            F.when(nat % 3 == 0, "No internet service")
            .when(key % 89 == 0, F.lit(None).cast("string"))
            .when(bal > 7000, "Yes").otherwise("No").alias("tech_support"),
            _internet_addon(nat, key % 7 < 3).alias("streaming_tv"),
            _internet_addon(nat, key % 11 < 5).alias("streaming_movies"),
            F.when(seg.isin("AUTOMOBILE", "BUILDING"), "Month-to-month")
            .when(seg == "FURNITURE", "One year")
            .when(seg == "HOUSEHOLD", "Two year")
            .otherwise(F.lit(None).cast("string")).alias("contract"),
            F.when(F.col("last_order") >= F.lit(CHURN_CUTOFF).cast("timestamp_ntz"), 0)
            .otherwise(1).cast("int").alias("churn_value"),
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment row per customer: the customer's first order (smallest key)."""
    f = _orders_by_customer(spark, sf_dir).select(
        "o_custkey", F.col("first.o_orderkey").alias("o_orderkey"), F.col("first.o_orderstatus").alias("o_orderstatus"),
        F.col("first.o_orderpriority").alias("o_orderpriority"), F.col("first.o_totalprice").alias("o_totalprice"))
    return _billing_rows(f)


def _billing_rows(orders: DataFrame) -> DataFrame:
    tenure = F.col("o_custkey") % 73
    return orders.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", "Yes").otherwise("No").alias("paperless_billing"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").alias("monthly_charges"),
        F.when(tenure == 0, F.lit(" "))
        .otherwise((F.col("o_totalprice").cast("decimal(14,2)") * tenure).cast("string"))
        .alias("total_charges"),
    )


def multi_billing_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables with text keys ("C-1") and every order as a billing row."""
    def text_key(df: DataFrame) -> DataFrame:
        return df.withColumn("customer_id", F.concat(F.lit("C-"), F.col("customer_id").cast("string")))

    return (text_key(customers(spark, sf_dir)), text_key(_billing_rows(read_table(spark, sf_dir, "orders"))),
            text_key(support_tickets(spark, sf_dir)))


def payments_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a payment row; the order status is the only billing column."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("order_status")
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("ticket_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("issue_type"),
        F.when(eid % 3 == 0, "Low").when(eid % 3 == 1, "Medium").otherwise("High").alias("severity"),
        F.col("value").alias("resolution_days"),
        F.when(eid % 5 == 0, "Pending").when(eid % 5 == 1, "Escalated").otherwise("Resolved").alias("status"),
        F.col("ts").alias("created_at"),
    )


def raw_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat, untyped export of customers + billing (the seed input of S10/S11):
    every field is text, so the seeding operators have to coerce and trim."""
    c = customers(spark, sf_dir)
    p = payments(spark, sf_dir)
    flat = c.join(p, "customer_id", "left")
    padded = ("gender", "contract", "payment_method", "customer_id")
    return flat.select(
        *[
            (F.concat(F.lit(" "), F.col(f).cast("string"), F.lit(" ")) if f in padded else F.col(f).cast("string"))
            .alias(f)
            for f in flat.columns
        ]
    )
