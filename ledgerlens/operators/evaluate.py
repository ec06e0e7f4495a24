"""Classifier evaluation as DataFrame aggregates.

Prediction frames carry ``y_true`` (0/1) and ``y_prob`` (score); any extra
columns (amount, tier, model) ride along.

* Confusion counts and the threshold sweep are one conditional aggregate
  (two counters per threshold) over the rows: one pass, map-side partial
  aggregation, no join against the threshold grid.
* Curves and their areas work on the score histogram (one row per distinct
  score).  Cumulative counts from the top score down are a prefix scan on two
  levels over range partitions, as many as the scores need, so no single
  task sees the whole histogram.
* Each curve point's predecessor is the cumulative count excluding its own
  score, so areas are plain sums (trapezoid rule, anchored at recall 0 /
  precision 1 for PR and at (0, 0) for ROC).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.functions.columns import f1_expr, safe_ratio
from ledgerlens.functions.joins import checked_broadcast
from ledgerlens.session import ensure_checkpoint_dir

Y, P = "y_true", "y_prob"
#: Distinct scores in a partition of the prefix scan, about.
BLOCK_SCORES = 20_000


def _pos(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0)).cast("long")


def confusion(pred: DataFrame, predicted: Column, group_cols: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn for a 0/1 prediction column.

    The prediction is projected before the aggregate, so it may hold scalar
    subqueries (a tuned threshold) over non-deterministic plans.
    """
    pred = pred.withColumn("_yhat", predicted)
    y, yhat = F.col(Y) == 1, F.col("_yhat") == 1
    return pred.groupBy(*(group_cols or [])).agg(
        _pos(y & yhat).alias("true_positives"), _pos(~y & yhat).alias("false_positives"),
        _pos(y & ~yhat).alias("false_negatives"), _pos(~y & ~yhat).alias("true_negatives"))


def with_metrics(counts: DataFrame) -> DataFrame:
    """precision / recall / f1 / accuracy from confusion counts (zero_division = 0)."""
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    out = counts.select("*", safe_ratio(tp, tp + fp).alias("precision"), safe_ratio(tp, tp + fn).alias("recall"),
                        safe_ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"))
    return out.select("*", f1_expr(F.col("precision"), F.col("recall")).alias("f1_score"))


def sweep(pred: DataFrame, thresholds: list[float] = config.EVAL_THRESHOLDS,
          group_cols: list[str] | None = None) -> DataFrame:
    """Metrics at every threshold of the grid, in one pass over ``pred``."""
    groups = list(group_cols or [])
    y, s = F.col(Y) == 1, F.col(P)
    aggs = [F.count(F.lit(1)).alias("_n"), _pos(y).alias("_p")]
    for i, t in enumerate(thresholds):
        aggs += [_pos(y & scored() & (s >= F.lit(float(t)))).alias(f"_tp{i}"), _pos(~y & scored() & (s >= F.lit(float(t)))).alias(f"_fp{i}")]
    wide = pred.groupBy(*groups).agg(*aggs)
    grid = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_tp{i}").alias("tp"),
                              F.col(f"_fp{i}").alias("fp")) for i, t in enumerate(thresholds)])
    long = wide.select(*groups, "_n", "_p", F.explode(grid).alias("g"))
    counts = long.select(
        *groups, F.col("g.threshold").alias("threshold"),
        F.col("g.tp").alias("true_positives"), F.col("g.fp").alias("false_positives"),
        (F.col("_p") - F.col("g.tp")).alias("false_negatives"),
        (F.col("_n") - F.col("_p") - F.col("g.fp")).alias("true_negatives"),
        F.col("_n").alias("sample_count"), F.col("_p").alias("fraud_count"))
    return with_metrics(counts)


def best_static_threshold(sweep_df: DataFrame) -> DataFrame:
    """Highest F1 (strictly above 0; ties -> lower threshold), else the default 0.50."""
    ranked = sweep_df.where(F.col("f1_score") > 0).agg(
        F.max_by("threshold", F.struct(F.col("f1_score"), -F.col("threshold"))).alias("t"),
        F.max("f1_score").alias("f"))
    return ranked.select(F.coalesce("t", F.lit(config.DEFAULT_THRESHOLD)).alias("threshold"),
                         F.coalesce("f", F.lit(0.0)).alias("f1_score"))


def scored() -> Column:
    """Whether a row has a score.  A null or NaN score is none: it never alerts and is on no curve."""
    return F.col(P).isNotNull() & ~F.isnan(P)


def reaches(threshold: Column) -> Column:
    return scored() & (F.col(P) >= threshold)


def predict_at(threshold: Column | float) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(reaches(t), 1).otherwise(0)


def positive_rate(pred: DataFrame) -> DataFrame:
    """Share of positives: the precision of a random ranking (PR baseline)."""
    return pred.agg(F.count(F.lit(1)).alias("n"), _pos(F.col(Y) == 1).alias("positives")).select(
        "n", "positives", safe_ratio(F.col("positives"), F.col("n")).alias("baseline_precision"))


# ---------------------------------------------------------------- curves
def score_histogram(pred: DataFrame) -> DataFrame:
    y = F.col(Y) == 1
    return pred.where(scored()).groupBy(P).agg(_pos(y).alias("pos"), _pos(~y).alias("neg"))


def cumulative_from_top(hist: DataFrame) -> DataFrame:
    """Add ``tp``/``fp``: positives/negatives with score >= this score.

    A prefix scan on two levels: scores are dealt to partitions by range, best first, and stored
    with their partition's number; partition totals are summed before each partition, and rows
    within it.  The driver knows the number of partitions, no scores.
    """
    ensure_checkpoint_dir(hist.sparkSession)
    n = max(1, -(-hist.count() // BLOCK_SCORES))  # partitions grow in number, not in size
    dealt = hist.repartitionByRange(n, F.desc(P)).withColumn("_part", F.spark_partition_id()).checkpoint()
    totals = dealt.groupBy("_part").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = totals.select("_part", F.coalesce(F.sum("_bp").over(above), F.lit(0)).alias("_op"),
                            F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_on"))
    inside = Window.partitionBy("_part").orderBy(F.desc(P)).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.select("*", F.sum("pos").over(inside).alias("_lp"), F.sum("neg").over(inside).alias("_ln"))
    return (local.join(checked_broadcast(offsets), "_part", "inner")
            .select(P, "pos", "neg", (F.col("_op") + F.col("_lp")).cast("long").alias("tp"),
                    (F.col("_on") + F.col("_ln")).cast("long").alias("fp")))


def _class_totals(pred: DataFrame) -> DataFrame:
    y = F.col(Y) == 1
    return pred.where(scored()).agg(_pos(y).alias("P"), _pos(~y).alias("N"))


def curve_points(pred: DataFrame) -> DataFrame:
    """Per distinct score: cumulative counts, the point and its predecessor."""
    tot = _class_totals(pred).select(F.struct("P", "N")).scalar()
    P_, N_ = tot["P"], tot["N"]
    ensure_checkpoint_dir(pred.sparkSession)
    cum = cumulative_from_top(score_histogram(pred).checkpoint())  # counted, cut and summed from one computation
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    return cum.select(
        F.col(P).alias("threshold"), "tp", "fp",
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(P_ > 0, F.col("tp") / P_).otherwise(F.lit(1.0)).alias("recall"),
        F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0)).alias("_prev_precision"),
        F.when(P_ > 0, tp0 / P_).otherwise(F.when(tp0 + fp0 > 0, 1.0).otherwise(0.0)).alias("_prev_recall"),
        F.when(N_ > 0, F.col("fp") / N_).alias("fpr"), F.when(P_ > 0, F.col("tp") / P_).alias("tpr"),
        F.when(N_ > 0, fp0 / N_).alias("_prev_fpr"), F.when(P_ > 0, tp0 / P_).alias("_prev_tpr"))


def pr_curve(pred: DataFrame) -> DataFrame:
    return pr_curve_from(curve_points(pred))


def pr_curve_from(points: DataFrame) -> DataFrame:
    pts = points.select("threshold", "precision", "recall")
    anchor = points.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                                 F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(anchor)


def roc_curve(pred: DataFrame) -> DataFrame:
    return roc_curve_from(curve_points(pred))


def roc_curve_from(points: DataFrame) -> DataFrame:
    pts = points.select("threshold", "fpr", "tpr")
    anchor = points.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(anchor)


def curve_areas(pred: DataFrame) -> DataFrame:
    """One row: pr_auc and roc_auc (trapezoid rule over the full curves)."""
    return curve_areas_from(curve_points(pred))


def curve_areas_from(points: DataFrame) -> DataFrame:
    pr = (F.col("recall") - F.col("_prev_recall")) * (F.col("precision") + F.col("_prev_precision")) / 2
    roc = (F.col("fpr") - F.col("_prev_fpr")) * (F.col("tpr") + F.col("_prev_tpr")) / 2
    return points.agg(F.sum(pr).alias("pr_auc"), F.sum(roc).alias("roc_auc"))
