"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from procura.llm import decontaminate, packing, quality, secret_scan, simhash
from procura.llm.common import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.drop_rejected(docs, read_table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.drop_near_duplicates(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the kept texts are redacted, private keys as whole blocks."""
    return secret_scan.redact_secrets(docs, rules=secret_scan.REDACTED)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document is packed into training sequences (a row a piece)."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
