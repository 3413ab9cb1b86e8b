"""Session construction and cluster-safe checkpoint handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on. Shuffle partitions are left to the caller /
# cluster defaults except in ``local_session``; AQE re-plans joins and
# coalesces small shuffles at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ebbflow") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("EBBFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The cluster names the folder in ``spark.checkpoint.dir``; it is read from
    the session and never overridden. Only a local-mode session (tests) without
    that setting gets a fresh temporary folder; a cluster session without it is
    an error, because a machine-local folder does not survive executor loss.
    """
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder (e.g. on HDFS/S3) for this cluster"
            )
        path = tempfile.mkdtemp(prefix="ebbflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def materialize(df, name: str):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and
    return a scan of it: cuts the lineage (a lost executor re-reads files
    instead of recomputing the joins) and keeps pushdown / pruning on reads."""
    import uuid
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/ebbflow-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Rows of a part of a small table at least and of any part at most, where rows are dealt out.
PART_ROWS = 4096, 16_384


def dealt(df, name: str):
    """Write ``df`` with its rows dealt evenly over as many parts as keep the cores busy: a small
    table is one file otherwise, and one task in every pass over it."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return materialize(df.repartition(max(1, -(-n // PART_ROWS[1]), min(cores, n // PART_ROWS[0]))), name)


def at_once(spark, calls: list) -> list:
    """Run functions that start independent jobs, two at the same time (each plan that is being made
    takes memory of the driver); their results, in order."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    with ThreadPoolExecutor(2) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]
