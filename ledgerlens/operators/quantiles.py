"""Quantile helpers.

``exact_percentiles`` (linear interpolation: numpy/pandas ``linear``, SQL
``quantile_cont``) and ``exact_quantiles_disc`` (inverse CDF: the value at
1-based rank ceil(p * n)) select exact order statistics per group without a
sketch and without ranking rows:

1. Values are counted per log-scale bucket (16 per octave; monotone in the
   value).  A group's bucket table has at most ~80,000 rows, and a window
   over it finds the bucket holding each target rank.
2. Only rows in those buckets are counted again, per 65,536 equal-width
   sub-buckets of the bucket's [min, max].
3. Only rows in the selected sub-buckets are counted per distinct value, and
   the value whose cumulative count covers the rank is picked.  This pass is
   skipped when every selected sub-bucket holds a single value.

Every pass is a grouped count with a map-side partial step, so a value held
by a third of all rows collapses to one (value, count) row per task and no
task holds more than one bucket table.  A ``percentile_approx`` sketch at an
accuracy fine enough to be exact would instead ship almost every value of a
group to the single task that merges that group's sketch.

``bucketize`` applies cuts with ``Bucketizer`` (a map-only JVM transformer).
``sketch_cuts`` gives approximate cuts from ``percentile_approx`` where
balance, not exactness, is the point (curve blocks).
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.joins import small_side

# Sketch accuracy of the SQL form of the exploration question (kept for the statement text).
DEFAULT_ACCURACY = 1_000_000
# percentile_approx targets 1-based rank ceil(p * n); p = 0.55 is stored just above 0.55, so
# 0.55 * 6000 rounds up to rank 3301.  A nudge far below the sketch error restores the
# inverse-CDF rank ceil(p * n) for exact decimal p.
PROB_NUDGE = 1e-12
STEPS_PER_OCTAVE = 16
SUB_BUCKETS = 65536
MAX_BROADCAST_TARGETS = 100_000


def inverse_cdf_probs(probs: list[float]) -> list[float]:
    return [min(1.0, max(0.0, p - PROB_NUDGE)) if 0.0 < p < 1.0 else p for p in probs]


def _log_bucket(v: Column) -> Column:
    """Monotone bucket id of a double: 0 for zero, +-(1 + 16*log2|v| shifted), clamped (no overflow)."""
    lg = F.least(F.greatest(F.log2(F.abs(v)) * STEPS_PER_OCTAVE, F.lit(-20000.0)), F.lit(20000.0))
    mag = F.floor(lg) + F.lit(20001)
    return F.when(v == 0, F.lit(0).cast("bigint")).when(v > 0, mag).otherwise(-mag)


def _covering(ranks: Column, n_targets: int, base: Column, count: Column) -> Column:
    """Indexes t of ``ranks`` with base <= ranks[t] < base + count."""
    return F.filter(F.sequence(F.lit(0), F.lit(n_targets - 1)),
                    lambda t: (ranks[t] >= base) & (ranks[t] < base + count))


def _select_ranks(src: DataFrame, ranks_of_n, n_targets: int) -> DataFrame:
    """(_k, _t, _v, _n): the value at 0-based rank ``ranks_of_n("_n")[_t]`` of ``_v`` within group
    ``_k`` (``_n`` = group size; ``ranks_of_n`` gets the size column's name).

    ``src`` has columns ``_k`` (group key, a struct: null-safe equality) and ``_v`` (no null/NaN).
    """
    # pass 1: log-bucket counts; group size and cumulative counts from one window per group
    b1 = src.select("_k", "_v", _log_bucket(F.col("_v")).alias("_b1"))
    l1 = b1.groupBy("_k", "_b1").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"),
                                     F.max("_v").alias("_hi"))
    grp = Window.partitionBy("_k")
    before = Window.partitionBy("_k").orderBy("_b1").rowsBetween(Window.unboundedPreceding, -1)
    l1 = l1.select("*", F.sum("_c").over(grp).alias("_n"),
                   F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    l1 = l1.select("*", ranks_of_n("_n").alias("_ranks"))
    sel1 = l1.select("_k", "_b1", "_lo", "_hi", "_base", "_n", "_ranks",
                     F.explode(_covering(F.col("_ranks"), n_targets, F.col("_base"), F.col("_c"))).alias("_t"))
    sel1, small1 = small_side(sel1, MAX_BROADCAST_TARGETS, with_flag=True)   # <= groups x targets rows
    buckets1 = sel1.select("_k", "_b1", "_lo", "_hi").distinct()

    # pass 2: rows of the selected buckets, counted per equal-width sub-bucket
    span = F.col("_hi") - F.col("_lo")
    sub = F.when(span > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / span * SUB_BUCKETS),
                                   F.lit(SUB_BUCKETS - 1))).otherwise(F.lit(0)).cast("bigint")
    rows2 = b1.join(F.broadcast(buckets1) if small1 else buckets1, ["_k", "_b1"], "inner") \
              .select("_k", "_b1", "_v", sub.alias("_b2"))
    l2 = rows2.groupBy("_k", "_b1", "_b2").agg(F.count(F.lit(1)).alias("_c2"), F.min("_v").alias("_mn"),
                                                F.max("_v").alias("_mx"))
    before2 = Window.partitionBy("_k", "_b1").orderBy("_b2").rowsBetween(Window.unboundedPreceding, -1)
    l2 = l2.select("*", F.coalesce(F.sum("_c2").over(before2), F.lit(0)).alias("_base2"))
    r = F.col("_ranks")[F.col("_t")] - F.col("_base")
    sel2 = (l2.join(sel1.select("_k", "_b1", "_base", "_ranks", "_t", "_n"), ["_k", "_b1"], "inner")
            .where((r >= F.col("_base2")) & (r < F.col("_base2") + F.col("_c2")))
            .select("_k", "_b1", "_b2", "_t", "_n", "_mn", "_mx",
                    (F.col("_ranks")[F.col("_t")] - F.col("_base") - F.col("_base2")).alias("_r")))
    sel2, small2 = small_side(sel2, MAX_BROADCAST_TARGETS, with_flag=True)
    # a sub-bucket holding one distinct value answers its targets directly (cent amounts: a
    # sub-bucket is narrower than a cent); the third pass runs only when some selected
    # sub-bucket still holds several values (one bounded count on the checkpointed table)
    if sel2.where(F.col("_mn") < F.col("_mx")).limit(1).count() == 0:
        return sel2.select("_k", "_t", F.col("_mn").alias("_v"), "_n")

    # pass 3: distinct values of the selected sub-buckets with their counts
    buckets2 = sel2.select("_k", "_b1", "_b2").distinct()
    l3 = (rows2.join(F.broadcast(buckets2) if small2 else buckets2, ["_k", "_b1", "_b2"], "inner")
          .groupBy("_k", "_b1", "_b2", "_v").agg(F.count(F.lit(1)).alias("_c3")))
    before3 = Window.partitionBy("_k", "_b1", "_b2").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    l3 = l3.select("*", F.coalesce(F.sum("_c3").over(before3), F.lit(0)).alias("_base3"))
    return (l3.join(sel2, ["_k", "_b1", "_b2"], "inner")
            .where((F.col("_r") >= F.col("_base3")) & (F.col("_r") < F.col("_base3") + F.col("_c3")))
            .select("_k", "_t", "_v", "_n"))


def _source(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    key = F.struct(*[F.col(g) for g in groups]) if groups else F.struct(F.lit(0).alias("_g"))
    return clean.select(key.alias("_k"), F.col(value).cast("double").alias("_v"))


def exact_quantiles_disc(df: DataFrame, value: str, probs: list[float],
                         group_cols: list[str] | None = None) -> DataFrame:
    """Rows (groups..., p, value): the value at 1-based rank ceil(p * n) (rank 1 for p = 0).

    p is taken as an exact fraction (0.55 = 11/20), so the rank is integer arithmetic.
    """
    groups = list(group_cols or [])
    fr = [Fraction(p).limit_denominator(1_000_000) for p in probs]

    def ranks(n: str) -> Column:
        # 0-based rank ceil(p * n) - 1 in integer arithmetic, clamped to [0, n - 1]
        return F.array(*[F.expr(f"least(greatest(({n} * {f.numerator} + {f.denominator - 1}) div {f.denominator} - 1,"
                                f" 0L), {n} - 1)") for f in fr])
    sel = _select_ranks(_source(df, value, groups), ranks, len(probs))
    plist = F.array(*[F.lit(float(p)) for p in probs])
    return sel.select(*[F.col("_k")[g].alias(g) for g in groups], plist[F.col("_t")].alias("p"),
                      F.col("_v").alias("value"))


def exact_percentiles(df: DataFrame, value: str, probs: list[float], group_cols: list[str] | None = None,
                      accuracy: int | None = None) -> DataFrame:
    """Rows (groups..., p, value) with exact linear-interpolated percentiles.

    The two order statistics around p * (n - 1) are selected exactly (``accuracy`` is accepted
    for older callers and unused: no sketch is involved).
    """
    groups = list(group_cols or [])
    k = len(probs)

    def ranks(n: str) -> Column:
        pos = [F.lit(float(p)) * (F.col(n) - 1) for p in probs]
        return F.array(*[F.floor(x).cast("bigint") for x in pos] + [F.ceil(x).cast("bigint") for x in pos])
    sel = _select_ranks(_source(df, value, groups), ranks, 2 * k)
    per = sel.groupBy("_k").agg(F.max("_n").alias("_n"),
                                *[F.max(F.when(F.col("_t") == t, F.col("_v"))).alias(f"_s{t}") for t in range(2 * k)])
    rows = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        d = pos - F.floor(pos)
        lo, hi = F.col(f"_s{i}"), F.col(f"_s{k + i}")
        rows.append(F.struct(F.lit(float(p)).alias("p"), (lo + (hi - lo) * d).alias("value")))
    return per.select(*[F.col("_k")[g].alias(g) for g in groups], F.explode(F.array(*rows)).alias("r")) \
              .select(*groups, "r.p", "r.value")


def cut_points(df: DataFrame, value: str, probs: list[float], accuracy: int | None = None) -> list[float]:
    """Sorted, de-duplicated exact cuts at ``probs`` (inverse CDF; a few scalars reach the driver)."""
    rows = exact_quantiles_disc(df, value, probs).select("value").collect()
    return sorted(set(float(r["value"]) for r in rows))


def sketch_cuts(df: DataFrame, value: str, probs: list[float], accuracy: int) -> list[float]:
    """Approximate cuts from one ``percentile_approx`` aggregate (for balancing, not reporting)."""
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    row = clean.agg(F.percentile_approx(value, inverse_cdf_probs(probs), accuracy).alias("cuts")).first()
    cuts = row["cuts"] if row is not None and row["cuts"] is not None else []
    return sorted(set(float(c) for c in cuts))


def bucketize(df: DataFrame, value: str, cuts: list[float], out: str) -> DataFrame:
    """0-based bucket of ``value``: number of cuts <= value (Bucketizer, [lo, hi) intervals).

    Equal cuts are merged first (Bucketizer needs strictly increasing splits);
    null/NaN values get a null bucket.
    """
    from pyspark.ml.feature import Bucketizer
    splits = [-float("inf")] + sorted(set(cuts)) + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=value, outputCol=out, handleInvalid="keep")
    res = b.transform(df)
    bad = F.col(value).isNull() | F.isnan(value)
    return res.withColumn(out, F.when(bad, F.lit(None)).otherwise(F.col(out).cast("int")))
