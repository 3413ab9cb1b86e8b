"""Connectors and sinks.

Reads always carry an explicit schema (no inference pass over the data);
writes are Spark writers (parallel, one file per task), never a driver loop.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


# --- S1: relational database over JDBC ---------------------------------------------------------

def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A partitioned JDBC read: with a numeric ``partition_column`` and bounds,
    ``num_partitions`` tasks each read one key range in parallel. The J1 join
    then runs in Spark, not in the database."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions or 8)))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               batch_size: int = 500, mode: str = "append") -> None:
    """S7 (database form): append in insert batches of ``batch_size`` rows per task."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


# --- S2/S5: flat files -----------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Typed CSV read; malformed fields become NULL (PERMISSIVE) instead of failing the job."""
    return spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE").csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Parquet by default, or CSV with a header."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S7 (file form): append a batch to a table folder."""
    df.write.mode("append").format(fmt).save(path)


# --- S3: source with fallback ----------------------------------------------------------------

def read_with_fallback(primary: Callable[[], DataFrame], secondary: Callable[[], DataFrame],
                       expected: T.StructType | None = None) -> DataFrame:
    """Try the primary source (schema resolution plus a one-row probe); on any
    failure use the secondary. Both must give the same schema."""
    try:
        df = primary()
        df.limit(1).collect()
    except Exception:  # noqa: BLE001 - any failure of the primary source falls back
        df = secondary()
    if expected is not None:
        df = conform(df, expected)
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a schema: missing columns as NULL, types cast with ``try_cast``."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


# --- S6: one-row JSON documents (metadata, reports) -------------------------------------------

def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row frame as a single JSON document (``coalesce(1)`` on one row)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json_row(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


# --- S8: fitted models ------------------------------------------------------------------------

def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def save_params(spark: SparkSession, params, path: str) -> None:
    """Fitted feature parameters as a one-row JSON table next to the model; code tables are
    copied beside it, so the saved parameters do not depend on the run's checkpoint folder."""
    tables = {}
    for c, source in params.category_tables.items():
        tables[c] = f"{path}-codes/{c}"
        spark.read.parquet(source).write.mode("overwrite").parquet(tables[c])
    params = replace(params, category_tables=tables)
    write_json_row(spark.createDataFrame([(params.to_json(),)], "params string"), path)


def load_params(spark: SparkSession, path: str):
    from ebbflow.operators.features import FeatureParams
    return FeatureParams.from_json(spark.read.schema("params string").json(path).first()["params"])


# --- S12: missing input guard -----------------------------------------------------------------

def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """An absent input gives an empty frame of the expected schema (the
    dashboard's behaviour), instead of an analysis error."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_json_or_empty(spark: SparkSession, path: str) -> dict:
    if not _exists(spark, path):
        return {}
    rows = spark.read.json(path).limit(1).collect()
    return json.loads(json.dumps(rows[0].asDict(recursive=True))) if rows else {}


def _exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system of the session (works for HDFS/S3 paths)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


# --- S9: table DDL from the fixed schemas ------------------------------------------------------

def ddl(name: str, schema: T.StructType, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS <name> (<columns>) USING parquet [LOCATION ...]``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
                     for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}"


def register_tables(spark: SparkSession, location: str, schemas: Mapping[str, T.StructType] | None = None,
                    database: str | None = None) -> list[str]:
    """Create the source tables in the session catalog over Parquet folders under ``location``."""
    from ebbflow import schemas as S
    schemas = schemas or {"customers": S.CUSTOMERS, "payments": S.PAYMENTS, "support_tickets": S.SUPPORT_TICKETS}
    full = {name: f"{database}.{name}" if database else name for name in schemas}
    for name, schema in schemas.items():
        spark.sql(ddl(full[name], schema, f"{location}/{name}"))
    return list(full.values())
