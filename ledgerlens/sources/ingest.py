"""Raw transaction CSV ingest: explicit schema, strict header check, cleaning.

The raw file repeats the header name ``Account`` (sender, then receiver).
Reading by position with an explicit all-string schema sidesteps the
duplicate names, avoids a second inference pass over the data, keeps bank
ids such as ``"010"`` intact, and lets every cast be a ``try_*`` so that a
malformed value becomes null instead of failing the job.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import config

RAW_SCHEMA = T.StructType([T.StructField(f"_raw{i}", T.StringType(), True)
                           for i in range(len(config.RAW_HEADER))])

CLEAN_COLUMNS = [
    "Timestamp", "From_Bank", "From_Account", "To_Bank", "To_Account",
    "Amount_Received", "Receiving_Currency", "Amount_Paid", "Payment_Currency",
    "Payment_Format", "Is_Laundering", "Hour", "Day_of_Week", "Is_Currency_Conversion",
]


class RawSchemaError(ValueError):
    pass


def validate_header(header: list[str], where: str = "input") -> None:
    """Every expected raw column must be present, in the expected positions.

    The second ``Account`` may also be spelled ``Account.1`` or ``Account_1``.
    """
    got = [h.strip().strip('"') for h in header]
    second = len(config.RAW_HEADER) - 1 - config.RAW_HEADER[::-1].index("Account")
    plain = ["Account" if i == second and h in config.ACCOUNT_SPELLINGS else h for i, h in enumerate(got)]
    if plain != config.RAW_HEADER:
        missing = sorted(set(config.RAW_HEADER) - set(plain))
        raise RawSchemaError(
            f"raw transaction header mismatch in {where}: expected {config.RAW_HEADER}, got {got}"
            + (f"; missing {missing}" if missing else ""))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of one file on any Hadoop filesystem (compressed ones too); no more is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    stream = p.getFileSystem(conf).open(p)
    try:
        data = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8")).readLine()
    finally:
        stream.close()


def validate_files(spark: SparkSession, paths: list[str]) -> None:
    """Check the header of every file; the first that differs stops the read, by name."""
    def check(path: str) -> None:
        line = first_line(spark, path)
        if line is not None:  # an empty file has no rows
            validate_header(line.lstrip("\ufeff").split(","), path)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(check, paths))


def read_raw(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    if validate:
        files = spark.read.text(path).inputFiles()
        if not files:
            raise RawSchemaError(f"no files in {path}")
        validate_files(spark, [unquote(f) for f in files])
    raw = (spark.read.schema(RAW_SCHEMA).option("header", True)
           .option("enforceSchema", True).option("mode", "PERMISSIVE").csv(path))
    return raw.select(*[F.col(f"_raw{i}").alias(n) for i, n in enumerate(config.CLEAN_NAMES)])


def add_row_features(df: DataFrame) -> DataFrame:
    """Hour, Day_of_Week (1 = Sunday) and the currency-conversion flag."""
    return df.select(
        "*",
        F.hour("Timestamp").cast("int").alias("Hour"),
        F.dayofweek("Timestamp").cast("int").alias("Day_of_Week"),
        F.when(F.col("Receiving_Currency") != F.col("Payment_Currency"), 1)
         .otherwise(0).cast("int").alias("Is_Currency_Conversion"),
    )


def clean(raw: DataFrame) -> DataFrame:
    """Typed, cleaned transactions; malformed values become null.

    Timestamps are wall-clock (``timestamp_ntz``), so hour and weekday do not
    depend on the session time zone.
    """
    ts = F.try_to_timestamp(F.trim("Timestamp"), F.lit(config.RAW_TIMESTAMP_FORMAT))
    typed = raw.select(
        ts.cast("timestamp_ntz").alias("Timestamp"),
        F.trim("From_Bank").alias("From_Bank"),
        F.trim("From_Account").alias("From_Account"),
        F.trim("To_Bank").alias("To_Bank"),
        F.trim("To_Account").alias("To_Account"),
        F.expr("try_cast(trim(Amount_Received) AS double)").alias("Amount_Received"),
        F.col("Receiving_Currency"),
        F.expr("try_cast(trim(Amount_Paid) AS double)").alias("Amount_Paid"),
        F.col("Payment_Currency"),
        F.col("Payment_Format"),
        F.expr("try_cast(trim(Is_Laundering) AS int)").alias("Is_Laundering"),
    )
    return add_row_features(typed).select(*CLEAN_COLUMNS)


def ingest(spark: SparkSession, path: str) -> DataFrame:
    return clean(read_raw(spark, path))
