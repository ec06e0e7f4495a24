"""The exploratory questions as Spark SQL over temp views.

``register`` publishes the cleaned table as ``transactions`` and a dated
variant as ``transactions_dated``; the statements below are the SQL form of
the DataFrame functions in ``operators/explore.py`` (same columns, same
exact sums and inverse-CDF quantiles, the latter as a view), planned by Catalyst the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.functions.columns import money_parts
from ledgerlens.functions.joins import small_side
from ledgerlens.operators.quantiles import exact_quantiles_disc

LABEL = "CASE WHEN Is_Laundering = 1 THEN 'Fraud' ELSE 'Normal' END AS label"
QUARTILES = [0.25, 0.5, 0.75]
# paid_dec and paid_rest are the two parts of an amount (functions/columns.py); their sums lose nothing
SUM_PAID = "(COALESCE(CAST(SUM(paid_dec) AS DOUBLE), 0D) + SUM(paid_rest))"

STATEMENTS = {
    "class_distribution": f"""
SELECT Is_Laundering, {LABEL}, COUNT(*) AS jumlah,
       ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0D / SUM(COUNT(*)) OVER (), 4) AS persentase
FROM transactions GROUP BY Is_Laundering""",
    "amount_stats": f"""
SELECT Is_Laundering, {LABEL},
       ROUND({SUM_PAID} / COUNT(Amount_Paid), 2) AS avg_amount,
       ROUND(MIN(Amount_Paid), 2) AS min_amount, ROUND(MAX(Amount_Paid), 2) AS max_amount,
       ROUND(STDDEV_SAMP(Amount_Paid), 2) AS std_amount,
       ROUND(MAX(q1), 2) AS q1_amount, ROUND(MAX(q2), 2) AS median_amount, ROUND(MAX(q3), 2) AS q3_amount
FROM transactions LEFT JOIN class_quartiles ON label_key <=> Is_Laundering GROUP BY Is_Laundering""",
    "payment_format_mix": f"""
SELECT Is_Laundering, {LABEL}, Payment_Format, COUNT(*) AS jumlah,
       ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0D / SUM(COUNT(*)) OVER (PARTITION BY Is_Laundering), 2) AS pct_dalam_kelas
FROM transactions GROUP BY Is_Laundering, Payment_Format""",
    "daily_timeline": f"""
SELECT CAST(Date AS STRING) AS tanggal, Is_Laundering, {LABEL}, COUNT(*) AS jumlah_transaksi,
       ROUND({SUM_PAID}, 2) AS total_amount
FROM transactions_dated WHERE Date IS NOT NULL GROUP BY Date, Is_Laundering""",
    "top_senders": f"""
SELECT From_Account, COUNT(*) AS tx_count_sent,
       {SUM_PAID} AS total_sent,
       COUNT(DISTINCT To_Account) AS unique_recipients, CAST(SUM(Is_Laundering) AS BIGINT) AS fraud_tx_count
FROM transactions GROUP BY From_Account ORDER BY tx_count_sent DESC, From_Account ASC LIMIT {config.TOP_SENDERS}""",
    "hourly_distribution": f"""
SELECT Hour, Is_Laundering, {LABEL}, COUNT(*) AS jumlah_transaksi
FROM transactions GROUP BY Hour, Is_Laundering""",
}


def register(spark: SparkSession, cleaned: DataFrame) -> None:
    dec, rest = money_parts("Amount_Paid")
    view = cleaned.withColumns({"paid_dec": dec, "paid_rest": rest})
    view.createOrReplaceTempView("transactions")
    view.selectExpr("*", "to_date(Timestamp) AS Date").createOrReplaceTempView("transactions_dated")


def register_quartiles(cleaned: DataFrame) -> None:
    """class_quartiles: one row a class, the exact order statistics (bucketed counts, no sketch).

    Counted and broadcast: a shuffle join on the class would send nearly all rows to one task.
    """
    q = exact_quantiles_disc(cleaned, "Amount_Paid", QUARTILES, ["Is_Laundering"])
    pick = [F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"q{i + 1}") for i, p in enumerate(QUARTILES)]
    small_side(q.groupBy(F.col("Is_Laundering").alias("label_key")).agg(*pick)).createOrReplaceTempView("class_quartiles")


def run(spark: SparkSession, cleaned: DataFrame, name: str) -> DataFrame:
    register(spark, cleaned)
    if name == "amount_stats":
        register_quartiles(cleaned)
    return spark.sql(STATEMENTS[name])
