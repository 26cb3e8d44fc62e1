"""A corpus prepared for training, stage by stage.

Every stage reads what the one before it wrote: documents in a known language, without boilerplate
lines, one of each group of near copies, without test items, packed into token windows. All but the
last return the columns of ``documents``.

A row is a document, with an id or without. Rows without id are judged by their text like others, but
lose no line; rows that share an id are one document to line dedup and copies, or linked, to near dedup.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import contamination, language, line_runs, near_dup, packing
from tickerloom.session import Staging, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go; the languages are learnt from the documents themselves."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated in five documents go from all but one; every document stays."""
    return line_runs.without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, with the smallest id there is."""
    return near_dup.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a test item go."""
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows, a row per piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]

# Fitted centroids, similarity search and the token vocabulary are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written as Parquet and read again, all but the last deleted in the end."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Staging(spark) as keep:
        for name, function in STAGES[:-1]:
            docs = keep(function(spark, docs, sf_dir), f"pipeline-{name}")
        name, function = STAGES[-1]
        return stage(function(spark, docs, sf_dir), f"pipeline-{name}")
