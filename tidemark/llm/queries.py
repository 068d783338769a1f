"""The registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.sharding import place

    return place(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.decontamination import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.tool_calls import from_conversations, link

    return link(*from_conversations(table(spark, sf_dir, "conversations")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.bpe import encode_decode_digest

    return encode_decode_digest(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.substring_dedup import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.language_model import language_model_scores

    return language_model_scores(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def queries() -> dict:
    ops = (
        op1_quality_rules, op2_sharding, op3_decontamination, op4_lm_scoring, op5_tool_calls,
        op6_bpe, op7_token_counts, op8_near_duplicates, op9_toxicity, op10_substring_dedup,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    from tidemark.llm import decontamination, sharding, tool_calls

    return {
        "op2_sharding": sharding.oracle_sql(),
        "op3_decontamination": decontamination.ORACLE_SQL,
        "op5_tool_calls": tool_calls.ORACLE_SQL,
    }
