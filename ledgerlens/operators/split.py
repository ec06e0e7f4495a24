"""Train/test split and majority-class downsampling.

Both are map-only hash predicates on the row key: no shuffle, no cache, and
the same rows are chosen however the input is partitioned (``randomSplit``
and ``sample`` both change with the partition layout).  Every row of each
class lands in train with probability 80/100, so the split is stratified in
expectation, as in the source pipeline.

``exact_split`` and ``exact_downsample`` take exact numbers instead: the rows of a
class with the smallest hashes, up to a quota.  The quota's hash is selected as an
order statistic (no ranking of rows), so choosing the rows stays a map-only
predicate with one cut a class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.functions.columns import hash_percent, hash_u32
from ledgerlens.functions.joins import small_side
from ledgerlens.operators.quantiles import _select_ranks

TWO_POW_32 = 4294967296.0
DOWNSAMPLE_SALT = "ds"


def assign_split(tx: DataFrame, key: str = "tx_key", train_percent: int = config.TRAIN_PERCENT) -> DataFrame:
    """Add ``split`` ('train'/'test') to every row (a pure function of the row key)."""
    return tx.withColumn("split", F.when(hash_percent(key) < train_percent, F.lit("train"))
                                   .otherwise(F.lit("test")))


def labelled(tx: DataFrame) -> DataFrame:
    """Rows whose label is 0 or 1 (others take part in neither split)."""
    return tx.where(F.col(config.TARGET_COL).isin(0, 1))


def with_split(tx: DataFrame, key: str = "tx_key", train_percent: int = config.TRAIN_PERCENT) -> DataFrame:
    """Add ``split`` ('train'/'test'); rows whose label is not 0/1 are dropped."""
    return assign_split(labelled(tx), key, train_percent)


def split_counts(tx_split: DataFrame) -> DataFrame:
    return tx_split.groupBy("split", config.TARGET_COL).agg(F.count(F.lit(1)).alias("n"))


def downsample_fraction(train: DataFrame, ratio: int = config.IMBALANCE_RATIO) -> DataFrame:
    """One-row frame: positives, negatives and the negative keep fraction.

    fraction = min(positives * ratio / negatives, 1); 1 when there are no negatives.
    """
    lab = F.col(config.TARGET_COL)
    counts = train.agg(F.sum(F.when(lab == 1, 1).otherwise(0)).cast("bigint").alias("positives"),
                       F.sum(F.when(lab == 0, 1).otherwise(0)).cast("bigint").alias("negatives"))
    frac = F.when(F.col("negatives") == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.col("positives").cast("double") * ratio / F.col("negatives").cast("double")))
    return counts.select("positives", "negatives", frac.alias("fraction"))


def downsample(train_features: DataFrame, fraction_source: DataFrame | None = None,
               ratio: int = config.IMBALANCE_RATIO, key: str = "tx_key") -> DataFrame:
    """Keep every positive and a hash-chosen ``fraction`` of negatives.

    ``fraction_source`` holds the train labels used for the class counts
    (defaults to ``train_features``); passing the narrow pre-join frame keeps
    the count off the feature joins.  The fraction is a scalar subquery, so
    the whole operator is one lazy plan.
    """
    src = train_features if fraction_source is None else fraction_source
    fraction = downsample_fraction(src.select(config.TARGET_COL), ratio).select("fraction").scalar()
    keep = (F.col(config.TARGET_COL) == 1) | (
        (F.col(config.TARGET_COL) == 0) & (hash_u32(key, DOWNSAMPLE_SALT).cast("double") < fraction * TWO_POW_32))
    return train_features.where(keep)


def sample_by_label(train: DataFrame, ratio: int = config.IMBALANCE_RATIO, seed: int = config.RANDOM_SEED) -> DataFrame:
    """``sampleBy`` with a seed: every positive and a drawn share of negatives.  The draw follows the
    partition layout; :func:`downsample` and :func:`exact_downsample` do not."""
    fraction = downsample_fraction(train.select(config.TARGET_COL), ratio).first()["fraction"]
    return train.sampleBy(config.TARGET_COL, {0: fraction, 1: 1.0}, seed)


# ---------------------------------------------------------------- exact quotas
def quota_cuts(rows: DataFrame, quota: Column, salt: str | None = None, key: str = "tx_key") -> DataFrame:
    """(label, cut_hash, cut_key, quota): the last row by (hash, key) within each class's quota.

    ``quota``: of ``_n``, the rows of the class.  Classes without a quota have no row.  Rows with
    equal keys stay together: quotas are exact where keys are unique.
    """
    hashed = rows.select(F.struct(F.col(config.TARGET_COL).alias("label")).alias("_k"), hash_u32(key, salt).cast("double").alias("_v"),
                         F.col(key).cast("string").alias("_key"))
    rank = lambda n: F.array(F.greatest(quota - 1, F.lit(0)).cast("bigint"))
    cuts = small_side(_select_ranks(hashed.select("_k", "_v"), rank, 1).select("_k", F.col("_v").alias("_cut"), quota.cast("bigint").alias("quota")))
    near = hashed.join(cuts, "_k")  # one row a class
    below = near.where("_v < _cut").groupBy("_k").agg(F.count(F.lit(1)).alias("_below"))
    order = F.row_number().over(Window.partitionBy("_k").orderBy("_key"))  # rows with one hash of 2**32
    ties = near.where("_v = _cut").withColumn("_place", order).join(below, "_k", "left")
    last = ties.where(F.col("_place") == F.col("quota") - F.coalesce("_below", F.lit(0)))
    return last.select(F.col("_k.label").alias("label"), F.col("_cut").alias("cut_hash"), F.col("_key").alias("cut_key"), "quota")


def within_quota(rows: DataFrame, cuts: DataFrame, salt: str | None = None, key: str = "tx_key") -> DataFrame:
    """Add ``_in``: whether a row is within its class's quota."""
    cuts = small_side(cuts)  # one row a class
    h, k = hash_u32(key, salt).cast("double"), F.col(key).cast("string")
    inside = (h < F.col("cut_hash")) | (h == F.col("cut_hash")) & (k <= F.col("cut_key"))
    return (rows.join(cuts, rows[config.TARGET_COL] == cuts["label"], "left")
            .withColumn("_in", F.coalesce(inside, F.lit(False))).drop("label", "cut_hash", "cut_key", "quota"))


def exact_split(tx: DataFrame, train_percent: int = config.TRAIN_PERCENT, key: str = "tx_key") -> DataFrame:
    """Rows with label 0 or 1 and ``split``: of each class exactly ``train_percent`` of 100 (rounded down) are train."""
    rows = labelled(tx).drop("split")
    cuts = quota_cuts(rows, F.expr(f"_n * {train_percent} div 100"), key=key)
    marked = within_quota(rows, cuts.where("quota > 0"), key=key)
    return marked.withColumn("split", F.when(F.col("_in"), F.lit("train")).otherwise(F.lit("test"))).drop("_in")


def exact_downsample(train: DataFrame, ratio: int = config.IMBALANCE_RATIO, key: str = "tx_key") -> DataFrame:
    """Every positive and exactly ``ratio`` times as many negatives (all, if there are fewer)."""
    lab = F.col(config.TARGET_COL)
    positives = downsample_fraction(train.select(config.TARGET_COL), ratio).select(F.coalesce("positives", F.lit(0))).first()[0]
    cuts = quota_cuts(train.where(lab == 0), F.least(F.col("_n"), F.lit(positives * ratio)), DOWNSAMPLE_SALT, key)
    marked = within_quota(train, cuts.where("quota > 0"), DOWNSAMPLE_SALT, key)
    return marked.where((lab == 1) | F.col("_in")).drop("_in")
