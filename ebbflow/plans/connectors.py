"""Queries over sources and sinks (S2-S7, S9, S12, P1, P16): each writes to the shared
folder, or names an absent input, and returns what is read back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F, types as T

from ebbflow import schemas as S
from ebbflow.plans import churn
from ebbflow.plans.catalog import _tables, evaluation_report, register
from ebbflow.session import ensure_checkpoint_dir
from ebbflow.sources import io
from ebbflow.sources.managed import ManagedTable

TABLE_SCHEMAS = {"customers": S.CUSTOMERS, "payments": S.PAYMENTS, "support_tickets": S.SUPPORT_TICKETS}


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/ebbflow-io-{uuid.uuid4().hex}"


@register
def csv_roundtrip(spark, sf_dir):
    """The feature table as CSV with a header, read with its schema."""
    path = _folder(spark)
    ft = churn.feature_table(spark, sf_dir)
    io.write_table(ft, path, fmt="csv")
    return io.read_csv(spark, path, ft.schema)


@register
def json_roundtrip(spark, sf_dir):
    """The evaluation report as a one-row JSON document."""
    path = _folder(spark)
    report = evaluation_report(spark, sf_dir)
    io.write_json_row(report, path)
    return io.read_json_row(spark, path, report.schema)


@register
def append_counts(spark, sf_dir):
    """The tickets appended to one table in a batch per severity."""
    path = _folder(spark)
    tickets = _tables(spark, sf_dir)["support_tickets"]
    for severity in ("Low", "Medium", "High"):
        io.append_table(tickets.where(F.col("severity") == severity), path)
    return spark.read.parquet(path).groupBy("severity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ticket_id").alias("n_tickets"))


@register
def repeatable_append(spark, sf_dir):
    """The tickets put in a batch per severity. One batch first fails before its manifest
    row, and one is put twice; each counts once."""
    tickets = _tables(spark, sf_dir)["support_tickets"]
    table = ManagedTable(spark, _folder(spark), tickets.schema)
    table.stage(tickets.where(F.col("severity") == "High"))
    for severity in ("Low", "Medium", "High", "Medium"):
        table.put(severity, tickets.where(F.col("severity") == severity))
    return table.read().groupBy("severity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ticket_id").alias("n_tickets"))


@register
def upsert_customers(spark, sf_dir):
    """Two thirds of the customers arrive without a churn value, all of them a month later,
    some moved; the second batch is run again another month later. Defaults, audit stamps and
    a generated key as the database's schema asks for."""
    schema = T.StructType([T.StructField("row_no", T.LongType()), *S.CUSTOMERS.fields])
    table = ManagedTable(spark, _folder(spark), schema, key=S.KEY, surrogate="row_no",
                         defaults={"senior_citizen": 0, "churn_value": 0}, n_parts=16)
    rows = _tables(spark, sf_dir)["customers"]
    number = F.col(S.KEY).cast("long")
    table.upsert(rows.where(number % 3 != 0).drop("churn_value"), datetime(2026, 1, 1))
    later = rows.withColumn("city", F.when(number % 5 == 0, "Moved").otherwise(F.col("city")))
    table.upsert(later, datetime(2026, 2, 1))
    table.upsert(later, datetime(2026, 3, 1))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return table.read().select("row_no", S.KEY, "city", "churn_value", text("created_at"), text("updated_at"))


@register
def ddl_tables(spark, sf_dir):
    """The three tables created by their DDL in a database of their own; the type and
    number of values of every column read back from them."""
    root, database = _folder(spark), f"ebbflow_{uuid.uuid4().hex}"
    for name, df in _tables(spark, sf_dir).items():
        io.write_table(io.conform(df, TABLE_SCHEMAS[name]), f"{root}/{name}")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/{database}'")
    out = None
    for table in io.register_tables(spark, root, TABLE_SCHEMAS, database):
        df = spark.table(table)
        types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "n_values")
        part = counts.select(F.lit(table.split(".")[1]).alias("table_name"), "column_name",
                             types[F.col("column_name")].alias("data_type"), "n_values")
        out = part if out is None else out.unionByName(part)
    return out


@register
def fallback_source(spark, sf_dir):
    """S3: no payments table lies in the folder, so the mapped one is used, in the fixed schema."""
    df = io.read_with_fallback(lambda: spark.read.schema(S.PAYMENTS).parquet(f"{sf_dir}/payments.parquet"),
                               lambda: _tables(spark, sf_dir)["payments"], S.PAYMENTS)
    return df.drop("created_at", "updated_at")


@register
def missing_input(spark, sf_dir):
    """An absent input counts as an empty table."""
    from ebbflow.operators.quality import table_counts
    return table_counts({
        "events": io.read_or_empty(spark, f"{sf_dir}/events.parquet", "event_id long, user_id long"),
        "support_tickets": io.read_or_empty(spark, f"{sf_dir}/support_tickets.parquet", S.SUPPORT_TICKETS)})


@register
def titled_features(spark, sf_dir):
    """The feature table under its titled column names."""
    from ebbflow.functions.scalar import title_names
    return title_names(churn.feature_table(spark, sf_dir))


@register
def api_rows(spark, sf_dir):
    """Rows under the scoring API's field names, without a ticket count, put in training order."""
    from ebbflow.operators.scoring import from_api_fields
    ft = churn.feature_table(spark, sf_dir)
    rows = ft.select(S.KEY, *[F.col(c).alias("_".join(w.capitalize() for w in c.split("_")))
                              for c in sorted(S.FEATURE_COLUMNS) if c != "support_ticket_count"])
    return from_api_fields(rows)
