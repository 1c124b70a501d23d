"""Registered queries of the training-data operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signals.llm import (
    decontaminate,
    dialogue,
    fingerprint,
    html_region,
    language,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    secrets,
    substring,
    token_output,
    warc,
)
from signals.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op1(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op2(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op3(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op4(spark, table(spark, sf_dir, "documents"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.op5(spark, table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op6(spark, table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_region.op7(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op8(spark, table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.op9(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.op10(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.op11(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.op12(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.op13(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_fingerprints": op4_fingerprints,
    "op5_token_output": op5_token_output,
    "op6_packing": op6_packing,
    "op7_html_text": op7_html_text,
    "op8_warc": op8_warc,
    "op9_language": op9_language,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE: dict[str, str] = {"op1_decontamination": decontaminate.ORACLE_SQL}
