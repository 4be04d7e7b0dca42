"""Queries of the operators, by the names the driver calls, and SQL for their results where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

import corpus_pipeline
from eventrank.llm import annsearch, decontaminate, language, linededup, neardup, packing, pii, quality, rules, secrets, spelling, unitdedup, vectorcode
from eventrank.llm import sql, sql_vectors
from eventrank.llm.common import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), TOKENIZER)


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(read(spark, folder, "documents"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(read(spark, folder, "documents"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(read(spark, folder, "documents"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return unitdedup.report(read(spark, folder, "documents"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.report(read(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.report(read(spark, folder, "documents"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.report(read(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.report(read(spark, folder, "documents"))


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return annsearch.report(read(spark, folder, "embeddings"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vectorcode.report(read(spark, folder, "embeddings"))


def load() -> tuple[dict[str, Query], dict[str, str]]:
    queries = {name: query for name, query in globals().items() if name.startswith("op") and callable(query)}
    queries["pipeline"] = corpus_pipeline.run
    return queries, sql.EXPECTED | sql_vectors.EXPECTED
