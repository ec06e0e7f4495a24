"""Ordinal encoding of categorical columns, fitted on training rows.

Codes follow sorted value order (0-based); a null seen in training is a
category of its own, sorted last; a value never seen in training gets -1.
The mapping is a small DataFrame (column, value, code) with one row per
distinct category, so it can be persisted as Parquet and reused; it is
joined back with a size-checked broadcast (shuffle join beyond the bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import config

UNKNOWN_CODE = -1.0
MAX_BROADCAST_CATEGORIES = 1_000_000


def fit_ordinal(train: DataFrame, columns: list[str] = config.CATEGORICAL_COLS) -> DataFrame:
    """Mapping table (column, value, code), codes as double.

    One scan: each row yields its (column, value) pairs, and a single distinct (map-side
    partial, so a task ships each category once) collects the categories of every column.
    The rank window then sees one row per category, never the training rows.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    values = train.select(F.inline(pairs)).distinct()
    w = Window.partitionBy("column").orderBy(F.asc_nulls_last("value"))
    return values.select("column", "value", (F.dense_rank().over(w) - 1).cast("double").alias("code"))


def transform_ordinal(df: DataFrame, mapping: DataFrame, columns: list[str] = config.CATEGORICAL_COLS,
                      max_broadcast: int = MAX_BROADCAST_CATEGORIES) -> DataFrame:
    """Replace each categorical column by its code (-1 when unseen).

    ``mapping`` is expected to be a stored table (a stage or Parquet); one bounded row count, then
    a broadcast per column.
    """
    small = mapping.limit(max_broadcast + 1).count() <= max_broadcast
    out = df
    for c in columns:
        m = mapping.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"),
                                                        F.col("code").alias(f"_code_{c}"))
        m = F.broadcast(m) if small else m
        out = (out.join(m, out[c].cast("string").eqNullSafe(m[f"_v_{c}"]), "left")
                  .withColumn(c, F.coalesce(F.col(f"_code_{c}"), F.lit(UNKNOWN_CODE)))
                  .drop(f"_v_{c}", f"_code_{c}"))
    return out
