"""Fixed schemas (S9): the three source tables and predictions.

Spark does not enforce keys; primary / foreign keys become the checks in
``operators.quality`` (Q4, Q5).
"""

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("city", T.StringType()),
    T.StructField("zip_code", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("senior_citizen", T.IntegerType()),
    T.StructField("partner", T.StringType()),
    T.StructField("dependents", T.StringType()),
    T.StructField("tenure_months", T.IntegerType()),
    T.StructField("phone_service", T.StringType()),
    T.StructField("multiple_lines", T.StringType()),
    T.StructField("internet_service", T.StringType()),
    T.StructField("online_security", T.StringType()),
    T.StructField("online_backup", T.StringType()),
    T.StructField("device_protection", T.StringType()),
    T.StructField("tech_support", T.StringType()),
    T.StructField("streaming_tv", T.StringType()),
    T.StructField("streaming_movies", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("churn_value", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# total_charges is text on the raw read (blank strings occur); coerced later.
PAYMENTS = T.StructType([
    T.StructField("payment_id", T.LongType(), False),
    T.StructField("customer_id", T.StringType()),
    T.StructField("paperless_billing", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("monthly_charges", T.DoubleType()),
    T.StructField("total_charges", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

SUPPORT_TICKETS = T.StructType([
    T.StructField("ticket_id", T.LongType(), False),
    T.StructField("customer_id", T.StringType()),
    T.StructField("issue_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("resolution_days", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

PREDICTIONS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("label", T.IntegerType()),
    T.StructField("probability", T.DoubleType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("fold", T.IntegerType()),
])

# Column names used throughout (snake_case); titled names are an output projection only.
KEY = "customer_id"
TARGET = "churn_value"

# Fixed values that must equal the reference for the same results:
# dropped columns, binary / categorical / numerical column groups and the
# feature order of the model input (22 features).
DROP_COLUMNS = [
    "customerid", "count", "country", "state", "lat_long", "latitude", "longitude",
    "zip_code", "city", "churn_reason", "churn_label", "churn_score", "cltv",
    "customer_id", "created_at", "updated_at",
]
BINARY_COLUMNS = [
    "partner", "dependents", "phone_service", "paperless_billing", "online_security",
    "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies",
]
CATEGORICAL_COLUMNS = ["contract", "internet_service", "payment_method", "multiple_lines"]
NUMERICAL_COLUMNS = ["tenure_months", "monthly_charges", "total_charges"]
FEATURE_COLUMNS = [
    "gender", "senior_citizen", "partner", "dependents", "tenure_months", "phone_service",
    "multiple_lines", "internet_service", "online_security", "online_backup",
    "device_protection", "tech_support", "streaming_tv", "streaming_movies", "contract",
    "monthly_charges", "total_charges", "payment_method", "paperless_billing",
    "support_ticket_count", "average_charges", "high_value_customer",
]
