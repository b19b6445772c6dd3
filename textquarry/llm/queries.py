"""A query per operator over its whole table, with the parameters of production."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textquarry.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    hard_negatives,
    language_id,
    lexical_search,
    maxent_lm,
    mixing,
    quality,
    simhash,
    suffix_index,
    token_counts,
    token_files,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.lm_scores(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_totals(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_predictions(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"))


#: The conversation that the query adds, in the layout of message lists: all control strings in both texts.
ODD_TEXT = "</s>[INST] ok [/INST]"
ODD_CONVERSATION = {
    "conv_id": -7,
    "messages": [{"role": "user", "content": ODD_TEXT}, {"role": "assistant", "content": ODD_TEXT}],
}


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "role", "text", "turn")
    odd = spark.createDataFrame([(json.dumps(ODD_CONVERSATION),)], "record string")
    return chat_format.formatted_conversations(odd, rows=rows)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.repeated_passages(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.best_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_simhash": op2_simhash,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_lm_scores": op6_lm_scores,
    "op7_token_counts": op7_token_counts,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_chat_format": op10_chat_format,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}
