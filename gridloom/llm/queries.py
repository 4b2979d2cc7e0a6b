"""Queries over whole tables, one for each operator, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontaminate, exact_dedup, language, lines, mixing, ngram_join, secrets, substrings, suffixes, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_dedup(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("rid")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents")).drop("kept", "rid")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.passage_dedup(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_decontaminate, op2_suffix_dedup, op3_toxicity, op4_mixing, op5_exact_dedup, op6_language_id, op7_ngram_join, op8_substring_dedup, op9_line_dedup, op10_secret_scan)}

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": suffixes.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op7_ngram_join": ngram_join.ORACLE,
    "op8_substring_dedup": substrings.ORACLE,
    "op9_line_dedup": lines.ORACLE,
    "op10_secret_scan": secrets.oracle(),
}
