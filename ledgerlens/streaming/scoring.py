"""Score newly arriving raw transaction files with the staged batch artifacts.

The source pipeline is batch only.  This module re-runs its "apply" half,
the part that treats test rows, on each micro-batch of new files: the
staged lookup tables fitted on the training rows, the stored encoder, a
stored model, then the tier boundaries and thresholds.  It introduces no new
operator; Structured Streaming only supplies incremental file discovery
and exactly-once bookkeeping (checkpointLocation + idempotent per-batch
output folders).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens import config
from ledgerlens.operators import encode, models, tiers
from ledgerlens.operators.features import build_features_from
from ledgerlens.plans.pipeline import with_row_key
from ledgerlens.sources import ingest


FILE = "_file"


def read_raw_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    raw = (spark.readStream.schema(ingest.RAW_SCHEMA).option("header", True)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(raw_dir))
    named = raw.select(*[F.col(f"_raw{i}").alias(n) for i, n in enumerate(config.CLEAN_NAMES)])
    return named.withColumn(FILE, F.input_file_name())


# a micro-batch's distinct (account, day) keys are broadcast into semi-joins up to this count
MAX_BATCH_KEYS = 2_000_000
LOOKUPS = ("sender_velocity", "sender_profile", "receiver_velocity", "receiver_profile")


def score_batch(spark: SparkSession, batch: DataFrame, pipeline_out: str, model: str,
                max_keys: int = MAX_BATCH_KEYS) -> DataFrame:
    """Score one micro-batch.  Its work grows with the batch, not with the training history:
    the staged lookup tables are cut down to the batch's accounts by broadcast semi-joins."""
    out = pipeline_out.rstrip("/")
    rows = batch.withColumn("split", F.lit("test"))
    tables = {name: spark.read.parquet(f"{out}/lookups/{name}") for name in LOOKUPS}
    feats = build_features_from(rows, tables, max_keys=max_keys)
    enc = encode.transform_ordinal(feats, spark.read.parquet(f"{out}/encoder"))
    pred = models.score(PipelineModel.load(f"{out}/models/{model}"), enc)
    tier_table = spark.read.parquet(f"{out}/rba_tier_config")  # thresholds and boundaries, a few rows
    return tiers.apply_tiers(tiers.with_tier(pred, tiers.boundaries_of(tier_table)), tier_table)


def start(spark: SparkSession, raw_dir: str, pipeline_out: str, sink_dir: str, checkpoint: str,
          model: str = "gbt_a", available_now: bool = True) -> StreamingQuery:
    """Alerts for each micro-batch go to ``sink_dir/batch_id=<n>`` (overwritten on replay)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by the header check, the keys and the scores
        try:
            files = [r[0] for r in batch.select(FILE).distinct().collect()]  # maxFilesPerTrigger at most
            ingest.validate_files(spark, [unquote(f) for f in files])
            rows = with_row_key(ingest.clean(batch.drop(FILE)))
            scored = score_batch(spark, rows, pipeline_out, model)
            scored.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = read_raw_stream(spark, raw_dir).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
