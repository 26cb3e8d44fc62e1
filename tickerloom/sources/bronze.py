"""Landed JSON documents: read, reject, keep the latest, flatten and type.

A price document holds one symbol's history as an array of all-text structs. A macro document
holds one series' observations, and only its path says which series it is.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import (
    Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T,
)
from pyspark.sql.streaming import DataStreamReader

from .. import schemas
from ..functions.guarded import day, number, whole_number

# The entity is the file's name without its ending, "." stands for a missing value.
ENTITY_PATTERN = r"([^/]+)\.json$"
MISSING = "."


class Documents(NamedTuple):
    good: DataFrame
    rejected: DataFrame


def _json(reader: DataFrameReader | DataStreamReader, path: str | list[str], schema: T.StructType, lines: bool):
    """One document per file (pretty-printed or not), or one per line with ``lines``."""
    return (
        reader.schema(schema)
        .option("multiLine", not lines)
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
        .withColumns({
            "file_path": F.col("_metadata.file_path"),
            "landed_at": F.col("_metadata.file_modification_time"),
        })
    )


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, landed_at, size)`` of every landed file; nothing is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file_path"), F.col("modificationTime").alias("landed_at"), F.col("length").alias("size"))


def to_read(files: DataFrame, known: DataFrame) -> DataFrame:
    """The files to parse for the same rows as parsing all would give: those not in ``known``, or in it with
    another time or size, and all that landed at or after the first of them.

    Of a symbol's day the newest landing counts, so a file that turns up late must not win over one that
    was read before but landed after it. Files usually turn up in order, and then the new ones are all.
    """
    columns = files.columns
    same = reduce(and_, [files[c].eqNullSafe(known[c]) for c in columns])
    first = files.join(known, same, "left_anti").agg(F.min("landed_at")).first()[0]
    return files.filter(F.lit(False) if first is None else F.col("landed_at") >= F.lit(first))


def literal_path(path: str) -> str:
    """``path`` with the characters escaped that a reader would take for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def entity_from_path(pattern: str = ENTITY_PATTERN) -> Column:
    return F.regexp_extract("file_path", pattern, 1)


def raw_price_documents(
    reader: DataFrameReader | DataStreamReader, path: str | list[str], lines: bool = False
) -> DataFrame:
    """Every landed price document with the reason to reject it, NULL for a usable one."""
    reason = (
        F.when(F.col("status") == "error", "error answer")
        .when(F.col(schemas.CORRUPT).isNotNull(), "unreadable")
        .when(F.col("meta.symbol").isNull() | F.col("values").isNull(), "no data")
    )
    return _json(reader, path, schemas.PRICE_DOCUMENT, lines).withColumn("reason", reason)


def split(documents: DataFrame) -> Documents:
    good = documents.filter(F.col("reason").isNull()).select(
        F.col("meta.symbol").alias("symbol"), "values", "file_path", "landed_at"
    )
    return Documents(good, rejected(documents))


def rejected(documents: DataFrame) -> DataFrame:
    """What is known of the documents of either kind that cannot be used."""
    told = [F.col(c) if c in documents.columns else F.lit(None).cast("string").alias(c) for c in ("code", "message")]
    return documents.filter(F.col("reason").isNotNull()).select("reason", *told, "file_path", "landed_at")


def price_documents(spark: SparkSession, path: str, lines: bool = False) -> Documents:
    """Landed price documents, split into usable and rejected ones."""
    return split(raw_price_documents(spark.read, path, lines))


def latest(documents: DataFrame, entity: Column, landed: Column | None = None) -> DataFrame:
    """The newest landing of each entity. Older ones drop out in the scan tasks, before the shuffle."""
    order = F.col("landed_at") if landed is None else landed
    newest = Window.partitionBy("_entity").orderBy(F.desc("_landed"), F.desc("file_path"))
    return (
        documents.withColumns({"_entity": entity, "_landed": order})
        .withColumn("_place", F.row_number().over(newest))
        .filter(F.col("_place") == 1)
        .drop("_entity", "_landed", "_place")
    )


def prices(documents: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """One typed row per symbol and trading day; text that does not parse becomes NULL."""
    return _typed(documents, symbols).select(*schemas.PRICES.names)


def _typed(documents: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    if symbols is not None:
        documents = documents.filter(F.col("symbol").isin(*symbols))
    days = documents.select("symbol", F.explode("values").alias("v"), "landed_at", "file_path")
    return days.select(
        "symbol",
        day(F.col("v.datetime")).alias("date"),
        *[number(F.col(f"v.{c}")).alias(c) for c in ("open", "high", "low", "close")],
        whole_number(F.col("v.volume")).alias("volume"),
        "landed_at", "file_path",
    )


def newest_prices(documents: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """``prices``, of which the newest landing counts day by day.

    A symbol may be landed many times, whole or in parts. Of every (symbol, date) the rows of the last
    landed file stay, by landing time and then by path; days that only an older file holds stay too.
    Rows repeated within that file all stay, for the quality checks to find. Older rows drop out in the
    scan tasks, before the shuffle.
    """
    newest = Window.partitionBy(*schemas.KEY).orderBy(F.desc("landed_at"), F.desc("file_path"))
    ranked = _typed(documents, symbols).withColumn("_place", F.rank().over(newest))
    return ranked.filter(F.col("_place") == 1).select(*schemas.PRICES.names)


def macro_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Every landed macro document with the reason to reject it, NULL for a usable one."""
    reason = F.when(F.col(schemas.CORRUPT).isNotNull(), "unreadable").when(
        F.col("observations").isNull(), "no data"
    )
    return _json(spark.read, path, schemas.MACRO_DOCUMENT, lines).withColumn("reason", reason)


def observations(
    documents: DataFrame,
    series: Sequence[str] | None = None,
    pattern: str = ENTITY_PATTERN,
) -> DataFrame:
    """Long ``(series_id, date, value)`` without the missing-value marker."""
    usable = documents.filter(F.col("reason").isNull())
    named = usable.withColumn("series_id", entity_from_path(pattern))
    if series is not None:
        named = named.filter(F.col("series_id").isin(*series))
    points = named.select("series_id", F.explode("observations").alias("o"))
    return points.filter(F.col("o.value") != MISSING).select(
        "series_id", day(F.col("o.date")).alias("date"), number(F.col("o.value")).alias("value")
    )
