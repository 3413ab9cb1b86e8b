"""Score arriving customer rows with Structured Streaming.

file source (fixed schema) -> encode with the fitted params, imputing nothing -> Q3
validate (a row that lacks a required field is rejected) -> M15 score -> ``foreachBatch`` appends valid rows to the scored sink and rejected
rows (with their violations) to a second sink. The query is stateless; the
checkpoint makes the sinks exactly-once across restarts (a batch is re-run
idempotently by batch id). ``trigger(availableNow=True)`` processes what has
landed and stops, which suits a scheduled job; a long-running job uses a
processing-time trigger instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbflow import schemas as S
from ebbflow.functions.scalar import risk_level, risk_message, round_half_up
from ebbflow.operators.features import FeatureParams, encode_strict
from ebbflow.operators.quality import scoring_rules, validate
from ebbflow.operators.scoring import THRESHOLD, LinearScorer


def score_frame(rows: DataFrame, params: FeatureParams, scorer: LinearScorer) -> DataFrame:
    """The per-batch transform (identical for batch and stream input)."""
    checked = validate(encode_strict(rows, params), scoring_rules(S.FEATURE_COLUMNS))
    p = scorer.probability()
    return checked.select(
        S.KEY, "is_valid", F.array_join("violations", ";").alias("violations"),
        (p > THRESHOLD).cast("int").alias("churn_prediction"), round_half_up(p, 4).alias("churn_probability"),
        risk_level(p).alias("churn_risk_level"), risk_message((p > THRESHOLD).cast("int"), batch=True).alias("message"),
    )


def start_scoring_stream(spark: SparkSession, source_dir: str, schema, params: FeatureParams, scorer: LinearScorer,
                         scored_dir: str, rejected_dir: str, checkpoint_dir: str,
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         processing_time: str = "30 seconds") -> StreamingQuery:
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scored = score_frame(batch, params, scorer).persist()
        try:
            # keyed by batch id so a replayed batch overwrites its own output only
            (scored.where("is_valid").drop("is_valid", "violations").withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{scored_dir}/batch_id={batch_id}"))
            (scored.where("NOT is_valid").select(S.KEY, "violations").withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{rejected_dir}/batch_id={batch_id}"))
        finally:
            scored.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
