"""Corpus preparation pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; between stages the data is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from procura.llm import stages
from procura.llm.common import read_table, stage

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", stages.quality_classifier),
    ("simhash near-dedup", stages.simhash_near_dedup),
    ("benchmark decontamination", stages.benchmark_decontamination),
    ("secret scans", stages.secret_scans),
    ("best-fit packing", stages.best_fit_packing),
]

#: Trained scores, kernels and tokenizers have no SQL form; the stages are
#: tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
