"""The operators bound to the test tables, by query name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chat, contamination, divergence, language, line_runs, mixing, near_dup, nearest, packing, spelling, token_counts, toxicity, url_lists,
)

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learnt from the documents that are not held out."""
    return language.identify(_read(spark, sf_dir, "documents"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return nearest.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item that is found in it."""
    return contamination.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, shares and truncated totals for every length that a document has."""
    return token_counts.suffix_sums(token_counts.histogram(_read(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole text, learnt from the labels that are not held out."""
    return toxicity.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a five-word shingle similarity of 0.75, by connected component."""
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective."""
    return chat.chat_digest(_read(spark, sf_dir, "conversations"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 and more code points found in five documents stay in the largest of them only."""
    return line_runs.line_digest(_read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token windows of 1024, piece by piece."""
    return packing.packing_digest(_read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active on the day it was fetched."""
    pages = _read(spark, sf_dir, "pages")
    return url_lists.filter_captures(url_lists.captures_of(pages), url_lists.entries_of(pages))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and the terms it uses most above the language."""
    return divergence.divergence(_read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with the near word it is a variant of, and the last of that chain."""
    return spelling.spelling_groups(_read(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix to the sources' targets takes."""
    return mixing.taken_words(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_nearest": op2_nearest,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_near_dup": op6_near_dup,
    "op7_chat_format": op7_chat_format,
    "op8_line_dedup": op8_line_dedup,
    "op9_packing": op9_packing,
    "op10_url_filter": op10_url_filter,
    "op11_source_divergence": op11_source_divergence,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_mixing": op13_mixing,
}

ORACLE: dict[str, str] = {
    "op7_chat_format": chat.ORACLE,
    "op8_line_dedup": line_runs.ORACLE,
    "op10_url_filter": url_lists.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
    "op13_mixing": mixing.ORACLE,
}
