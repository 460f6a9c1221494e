"""One query per operator, bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm.llm.best_fit import pack_documents
from loghelm.llm.burst_trie import trie_nodes
from loghelm.llm.chat_buffers import formatted, read_back
from loghelm.llm.common import table
from loghelm.llm.contracts_sql import CONTROL_TEXT, TRIE, chat_sql, codes_sql, contamination_sql
from loghelm.llm.lexicon import toxicity_scores
from loghelm.llm.nbsvm import quality_scores
from loghelm.llm.positional_index import contamination
from loghelm.llm.prefix_forest import nearest
from loghelm.llm.simhash_pivots import simhash_components
from loghelm.llm.slice_masks import product_codes
from loghelm.llm.suffix_arrays import remove_repeats
from loghelm.llm.suffix_tree_lm import suffix_tree_scores
from loghelm.llm.token_files import encoded_documents
from loghelm.llm.url_terms import judge_urls, url_sql


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(table(spark, sf_dir, "documents"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(table(spark, sf_dir, "conversations"))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_codes(table(spark, sf_dir, "embeddings"))


def chat_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    return read_back(formatted(turns.unionByName(spark.createDataFrame(added, "conv_id long, turn long, role string, text string"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_arrays": suffix_dedup,
    "op2_prefix_forest": neighbours,
    "op3_positional_index": decontamination,
    "op4_best_fit": packing,
    "op5_nbsvm": quality,
    "op6_lexicon": toxicity,
    "op7_token_files": token_output,
    "op8_suffix_tree": lm_scores,
    "op9_url_terms": url_filter,
    "op10_simhash_pivots": simhash,
    "op11_burst_trie": conversation_trie,
    "op12_slice_masks": vector_codes,
    "op13_chat_buffers": chat_output,
}
SQL: dict[str, str] = {
    "op3_positional_index": contamination_sql(),
    "op9_url_terms": url_sql(),
    "op11_burst_trie": TRIE,
    "op12_slice_masks": codes_sql(),
    "op13_chat_buffers": chat_sql(),
}
