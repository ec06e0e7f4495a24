"""Registered queries of the operators: each applies one to its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import (bpe, exact_dedup, fingerprints, lexical_search, license_scan, line_dedup, mixing, ngram_join,
                            passage_dedup, quality_rules, secret_scan, spelling_variants, suffix_dedup)
from ledgerlens.llm.common import benchmark, documents

#: Where the public tokenizer files are; never copied here.
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_mix(documents(spark, sf_dir))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.document_lines(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_documents(documents(spark, sf_dir), tokenizer_path())


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.document_repeats(documents(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.document_secrets(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.document_quality(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.document_licenses(documents(spark, sf_dir))


def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.repeated_passages(documents(spark, sf_dir))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(documents(spark, sf_dir))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_to_weights": op1_mix_to_weights,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_line_dedup": op3_line_dedup,
    "op4_bpe": op4_bpe,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_passage_dedup": op7_passage_dedup,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_quality_rules": op9_quality_rules,
    "op10_license_scan": op10_license_scan,
    "op11_ranked_search": op11_ranked_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_exact_dedup": op13_exact_dedup,
}
