"""Render transactions in the raw CSV layout and read them back through ingest.

The raw layout repeats the header name ``Account``, which a DataFrame
writer cannot emit as column names.  Each row is therefore formatted into
one text field (with a separator that never occurs in the data) whose
column name is the literal header line, so every part file starts with
the exact raw header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.session import scratch_dir
from ledgerlens.sources import ingest
from ledgerlens.sources.fixtures import transactions

RAW_TS_OUT = "yyyy/MM/dd HH:mm"


def to_raw_lines(clean_tx: DataFrame) -> DataFrame:
    fields = [
        F.date_format("Timestamp", RAW_TS_OUT), F.col("From_Bank"), F.col("From_Account"), F.col("To_Bank"),
        F.col("To_Account"), F.col("Amount_Received").cast("string"), F.col("Receiving_Currency"),
        F.col("Amount_Paid").cast("string"), F.col("Payment_Currency"), F.col("Payment_Format"),
        F.col(config.TARGET_COL).cast("string"),
    ]
    line = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
    return clean_tx.select(line.alias(",".join(config.RAW_HEADER)))


def write_raw_csv(clean_tx: DataFrame, path: str) -> str:
    (to_raw_lines(clean_tx).write.mode("overwrite").option("header", True)
     .option("sep", "\u0001").option("quote", "\u0000").csv(path))
    return path


def ingest_roundtrip(spark: SparkSession, sf_dir: str, clean_tx: DataFrame | None = None) -> DataFrame:
    """Write the derived transactions (``clean_tx``, default: built from ``sf_dir``) as raw CSV in
    the shared scratch folder, then ingest them."""
    src = transactions(spark, sf_dir) if clean_tx is None else clean_tx
    path = write_raw_csv(src, scratch_dir(spark, "raw-csv"))
    return ingest.ingest(spark, path)
