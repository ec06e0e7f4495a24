"""Exploratory tables over cleaned transactions.

Each function returns a small DataFrame; all of them are single-pass
grouped aggregates with map-side partial aggregation (shares of a total use
a window over the already-aggregated rows, never over the input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.functions.columns import exact_mean, exact_sum, label_text
from ledgerlens.operators.comoments import correlations
from ledgerlens.operators.quantiles import exact_percentiles, exact_quantiles_disc

LAB = config.TARGET_COL


def class_distribution(tx: DataFrame) -> DataFrame:
    g = tx.groupBy(LAB).agg(F.count(F.lit(1)).alias("jumlah"))
    total = F.sum("jumlah").over(Window.partitionBy())
    return g.select(LAB, label_text(LAB).alias("label"), "jumlah",
                    F.round(F.col("jumlah").cast("double") * 100.0 / total, 4).alias("persentase"))


def amount_stats(tx: DataFrame) -> DataFrame:
    """Per class: mean (exact decimal sum), min, max, sample stddev and the inverse-CDF quartiles.

    The quartiles are exact order statistics (``exact_quantiles_disc``: bucketed counts, no
    sketch); both sides of the final join hold one row per class.
    """
    a = "Amount_Paid"
    g = tx.groupBy(LAB).agg(exact_mean(a).alias("avg_amount"), F.min(a).alias("min_amount"),
                            F.max(a).alias("max_amount"), F.stddev_samp(a).alias("std_amount"))
    probs = [0.25, 0.5, 0.75]
    q = exact_quantiles_disc(tx, a, probs, [LAB])
    qw = q.groupBy(F.col(LAB).alias("_lab")).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"_q{i}")
                                                   for i, p in enumerate(probs)])
    # one row per class on both sides; AQE picks the join from their actual sizes
    j = g.join(qw, g[LAB].eqNullSafe(qw["_lab"]), "left")
    return j.select(LAB, label_text(LAB).alias("label"),
                    F.round("avg_amount", 2).alias("avg_amount"), F.round("min_amount", 2).alias("min_amount"),
                    F.round("max_amount", 2).alias("max_amount"), F.round("std_amount", 2).alias("std_amount"),
                    F.round("_q0", 2).alias("q1_amount"), F.round("_q1", 2).alias("median_amount"),
                    F.round("_q2", 2).alias("q3_amount"))


def payment_format_mix(tx: DataFrame) -> DataFrame:
    g = tx.groupBy(LAB, "Payment_Format").agg(F.count(F.lit(1)).alias("jumlah"))
    cls = F.sum("jumlah").over(Window.partitionBy(LAB))
    return g.select(LAB, label_text(LAB).alias("label"), "Payment_Format", "jumlah",
                    F.round(F.col("jumlah").cast("double") * 100.0 / cls, 2).alias("pct_dalam_kelas"))


def daily_timeline(tx: DataFrame) -> DataFrame:
    d = tx.select(F.to_date("Timestamp").alias("Date"), LAB, "Amount_Paid").where(F.col("Date").isNotNull())
    g = d.groupBy("Date", LAB).agg(F.count(F.lit(1)).alias("jumlah_transaksi"),
                                   exact_sum("Amount_Paid").alias("total_amount"))
    return g.select(F.col("Date").cast("string").alias("tanggal"), LAB, label_text(LAB).alias("label"),
                    "jumlah_transaksi", F.round("total_amount", 2).alias("total_amount"))


def top_senders(tx: DataFrame, k: int = config.TOP_SENDERS) -> DataFrame:
    """Top-k senders by count; ties broken by account id for a deterministic report."""
    g = tx.groupBy("From_Account").agg(
        F.count(F.lit(1)).alias("tx_count_sent"), exact_sum("Amount_Paid").alias("total_sent"),
        F.count_distinct("To_Account").alias("unique_recipients"),
        F.sum(LAB).cast("long").alias("fraud_tx_count"))
    return g.orderBy(F.desc("tx_count_sent"), F.asc("From_Account")).limit(k)


def hourly_distribution(tx: DataFrame) -> DataFrame:
    g = tx.groupBy("Hour", LAB).agg(F.count(F.lit(1)).alias("jumlah_transaksi"))
    return g.select("Hour", LAB, label_text(LAB).alias("label"), "jumlah_transaksi")


def fraud_daily(tx: DataFrame) -> DataFrame:
    return daily_timeline(tx.where(F.col(LAB) == 1))


def fraud_hourly(tx: DataFrame) -> DataFrame:
    return hourly_distribution(tx.where(F.col(LAB) == 1))


def fraud_peak_hour(tx: DataFrame) -> DataFrame:
    """Hour with the most fraud transactions (ties -> earliest hour)."""
    h = fraud_hourly(tx).where(F.col("Hour").isNotNull())
    return h.agg(F.max_by("Hour", F.struct(F.col("jumlah_transaksi"), -F.col("Hour"))).alias("peak_hour"),
                 F.max("jumlah_transaksi").alias("peak_count"))


def correlation(df: DataFrame, columns: list[str] = config.CORRELATION_FEATURES, digits: int = 9) -> DataFrame:
    """Pearson matrix in long form (feature_x, feature_y, corr), pairwise-complete like pandas.

    One pass of mergeable co-moments; the k x k result is the only thing that reaches the driver.
    A constant column yields null (undefined), never a division error.
    """
    cells = correlations(df, [c for c in columns if c in df.columns])
    table = df.sparkSession.createDataFrame(cells, "feature_x string, feature_y string, corr double")
    return table.select("feature_x", "feature_y", F.round("corr", digits).alias("corr"))


def class_weight(train: DataFrame) -> DataFrame:
    """Class counts and the positive-class weight negatives / positives (null without positives)."""
    lab = F.col(LAB)
    g = train.agg(F.sum(F.when(lab == 0, 1).otherwise(0)).cast("long").alias("negatives"),
                  F.sum(F.when(lab == 1, 1).otherwise(0)).cast("long").alias("positives"))
    return g.select("negatives", "positives",
                    F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives")).alias("scale_pos_weight"))


def format_share(tx: DataFrame) -> DataFrame:
    """Share of each payment format within each class (fractions)."""
    g = tx.groupBy(LAB, "Payment_Format").agg(F.count(F.lit(1)).alias("n"))
    cls = F.sum("n").over(Window.partitionBy(LAB))
    return g.select(LAB, label_text(LAB).alias("label"), "Payment_Format",
                    (F.col("n").cast("double") / cls).alias("proportion"))


def class_median(tx: DataFrame, digits: int = 6) -> DataFrame:
    m = exact_percentiles(tx, "Amount_Paid", [0.5], [LAB])
    return m.select(LAB, label_text(LAB).alias("label"), F.round("value", digits).alias("median_amount"))


BOX_PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def amount_log_box(tx: DataFrame, digits: int = 9) -> DataFrame:
    """Five numbers of log10(amount + 1e-5) per class (linear interpolation)."""
    lg = tx.select(LAB, F.log10(F.col("Amount_Paid") + F.lit(1e-5)).alias("log_amount"))
    q = exact_percentiles(lg, "log_amount", BOX_PROBS, [LAB])
    names = ["min_log", "q1_log", "median_log", "q3_log", "max_log"]
    pick = [F.round(F.max(F.when(F.col("p") == p, F.col("value"))), digits).alias(n) for p, n in zip(BOX_PROBS, names)]
    return q.groupBy(LAB).agg(*pick).select(LAB, label_text(LAB).alias("label"), *names)
