"""Corpus pipeline over ``documents``: five stages, each applying one operator of ``ledgerlens.llm``.

Every stage reads what its predecessor kept, as Parquet in the shared checkpoint folder.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bpe, line_dedup, mixing, ngram_join, quality_rules
from ledgerlens.llm.common import documents, stored
from ledgerlens.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy does not reject."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that an earlier line equals or nears; documents of which nothing is left go."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return ngram_join.keep_one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them: not at all, once, or up to three times."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document's ids and decoded text."""
    return bpe.encoded_documents(docs, tokenizer_path())


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies),
          ("mixing to weights", mix), ("BPE encoding", encode)]
#: Mixing draws and BPE merges are beyond SQL; the tests hold the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
