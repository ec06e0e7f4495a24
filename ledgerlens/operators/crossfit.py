"""Thresholds tuned apart from the rows they judge.

Rows fall into folds by a hash of their key.  One grouped sweep counts every fold (and tier) at every
threshold; the counts of a fold's complement are the sums over the other folds, so tuning for all
folds takes the one pass that tuning on everything takes.  Each row is then judged by thresholds
tuned without its fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.functions.columns import hash_u32
from ledgerlens.operators import evaluate as ev, tiers

FOLDS = 5
FOLD_SALT = "fold"
_COUNTS = ("true_positives", "false_positives", "false_negatives", "true_negatives", "sample_count", "fraud_count")


def with_fold(pred: DataFrame, folds: int = FOLDS, key: str = "tx_key") -> DataFrame:
    return pred.withColumn("fold", (hash_u32(key, FOLD_SALT) % folds).cast("int"))


def complement_sweep(pred: DataFrame, folds: int = FOLDS, group_cols: tuple[str, ...] = (),
                     thresholds: list[float] = config.EVAL_THRESHOLDS) -> DataFrame:
    """Metrics at every threshold over the rows outside each fold; ``pred`` has the column ``fold``."""
    inside = ev.sweep(pred, thresholds, ["fold", *group_cols])
    other = F.filter(F.array(*[F.lit(i) for i in range(folds)]), lambda i: i != F.col("fold"))
    moved = inside.withColumn("fold", F.explode(other))  # folds x tiers x thresholds rows
    return ev.with_metrics(moved.groupBy("fold", *group_cols, "threshold").agg(*[F.sum(c).alias(c) for c in _COUNTS]))


def static_thresholds(pred: DataFrame, folds: int = FOLDS) -> DataFrame:
    """fold -> the threshold of highest F1 outside the fold (ties: the lower one; 0.50 where none is above 0)."""
    sweep = complement_sweep(pred, folds)
    best = F.max_by(F.when(F.col("f1_score") > 0, F.col("threshold")), F.when(F.col("f1_score") > 0, F.struct("f1_score", -F.col("threshold"))))
    return sweep.groupBy("fold").agg(F.coalesce(best, F.lit(config.DEFAULT_THRESHOLD)).alias("threshold"), F.max("f1_score").alias("f1_score"))


def tier_thresholds(pred_tiered: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(fold, tier) -> threshold, and the rows and frauds of the tier outside the fold."""
    sweep = complement_sweep(pred_tiered.where(F.col("tier").isNotNull()), folds, ("tier",))
    names = pred_tiered.sparkSession.createDataFrame([(i, t) for i in range(folds) for t in config.TIERS], "fold int, tier string")
    return tiers.pick_thresholds(sweep, names, ["fold", "tier"])


def apply_tiers(pred_tiered: DataFrame, table: DataFrame) -> DataFrame:
    """Add ``y_pred_dynamic``: score >= the threshold of the row's fold and tier (0 without a tier)."""
    known = F.broadcast(table.select("fold", "tier", F.col("threshold").alias("_t")))  # folds x tiers rows
    judged = pred_tiered.join(known, ["fold", "tier"], "left")
    return judged.withColumn("y_pred_dynamic", F.when(F.col("_t").isNotNull() & ev.reaches(F.col("_t")), 1).otherwise(0)).drop("_t")
