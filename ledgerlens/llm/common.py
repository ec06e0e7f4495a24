"""Shared pieces of the operators: stored intermediate tables, input columns, bucket counts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_dir

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written as Parquet in the shared checkpoint folder, and read back.

    It cuts the lineage: a lost executor costs at most the tasks since the last stored table.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows up to which a stored table of short rows is broadcast, after counting it; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def bucket_count(spark: SparkSession, size: int, per_bucket: int) -> int:
    """Buckets for an exchange by hash: a bounded share each, and several for each partition."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // per_bucket))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the executors run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-"), "ledgerlens_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)  # the driver serves it; nothing is read from its folder
    _shipped.add(app)
