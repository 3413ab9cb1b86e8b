"""Tables written once to the shared checkpoint folder and read back.

Cutting the lineage with written files keeps a job whole when executors are lost;
the folder is the one that the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ebbflow.session import ensure_checkpoint_dir


def fresh_path(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/ebbflow-llm/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a scan of it."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
