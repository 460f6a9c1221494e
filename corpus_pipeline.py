"""Training corpus pipeline: one stage per operator, in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loghelm.llm.best_fit import pack_documents
from loghelm.llm.common import store, table
from loghelm.llm.lexicon import drop_toxic
from loghelm.llm.positional_index import drop_contaminated
from loghelm.llm.simhash_pivots import keep_one_per_component
from loghelm.llm.suffix_arrays import cut_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return keep_one_per_component(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also start earlier are cut out of the texts."""
    return cut_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into bins: one row per piece."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
