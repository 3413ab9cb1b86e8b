"""S10/S11 seeding and P4-P6 cleaning of untyped input.

The reference splits one flat, untyped record set into the ``customers`` and
``payments`` tables: text fields are stripped, numbers coerced (unparsable ->
missing), three integer fields filled with 0, and the two charge columns of
``payments`` median-filled. Each is a single ``select`` of column expressions;
the medians come from one exact percentile pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbflow.functions.scalar import clean_string, coerce_int, coerce_numeric
from ebbflow.operators import stats

CUSTOMER_TEXT = [
    "gender", "partner", "dependents", "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv",
    "streaming_movies", "contract",
]


def build_customers(flat: DataFrame) -> DataFrame:
    """The customers table (21 columns) from flat text rows."""
    return flat.select(
        clean_string("customer_id").alias("customer_id"),
        clean_string("city").alias("city"),
        coerce_numeric(F.trim("zip_code"), "double").try_cast("int").alias("zip_code"),
        coerce_numeric("latitude").alias("latitude"),
        coerce_numeric("longitude").alias("longitude"),
        clean_string("gender").alias("gender"),
        coerce_int("senior_citizen", to="int").alias("senior_citizen"),
        clean_string("partner").alias("partner"),
        clean_string("dependents").alias("dependents"),
        coerce_int("tenure_months", to="int").alias("tenure_months"),
        *[clean_string(c).alias(c) for c in CUSTOMER_TEXT if c not in ("gender", "partner", "dependents")],
        coerce_int("churn_value", to="int").alias("churn_value"),
    )


def build_payments(flat: DataFrame, distinct_limit: int = stats.DISTINCT_LIMIT) -> DataFrame:
    """The payments table (5 columns); missing charges filled with their medians."""
    typed = flat.select(
        clean_string("customer_id").alias("customer_id"),
        clean_string("paperless_billing").alias("paperless_billing"),
        clean_string("payment_method").alias("payment_method"),
        coerce_numeric("monthly_charges").alias("monthly_charges"),
        coerce_numeric("total_charges").alias("total_charges"),
    )
    med = stats.percentiles(typed, ["monthly_charges", "total_charges"], [0.5], distinct_limit=distinct_limit)
    return typed.withColumns({
        c: F.coalesce(F.col(c), F.lit(med[((), c)][0]).cast("double")) for c in ("monthly_charges", "total_charges")
    })


def clean_strings(df: DataFrame, cols) -> DataFrame:
    """P5 on the named columns, other columns unchanged."""
    return df.withColumns({c: clean_string(c) for c in cols})
