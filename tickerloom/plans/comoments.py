"""Correlations that are kept: the pairs' sums are stored by span of dates and merged when asked for.

A pair's correlation over all history is put together from one row per span, so days that are new or
corrected cost the sums of their own spans and no more. The table is partitioned by span; a refresh
overwrites the spans from the first changed day on and leaves the files of all others alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.correlation import DAYS, SPAN_SUMS, correlation_of, span_sums
from ..sources.ledger import Ledger
from ..sources.tables import Table, table_exists
from .pipeline import GOLD, KEYS

FOLLOWER = "comoments"
_EPOCH = dt.date(1970, 1, 1)


def first_day(day: dt.date) -> dt.date:
    """The first day of the span that ``day`` is in."""
    return _EPOCH + dt.timedelta((day - _EPOCH).days // DAYS * DAYS)


def refresh(features: Table, path: str, since: dt.date | None = None) -> None:
    """Compute the sums of the spans from ``since`` on, of all spans without it or on the first run."""
    known = since is not None and table_exists(features.spark, path)
    rows = features.rows(since=first_day(since)) if known else features.rows()
    sums = span_sums(rows.select("symbol", "date", "return_1d"), "return_1d")
    (
        sums.repartition("span", "symbol_a").sortWithinPartitions("span", "symbol_a", "symbol_b")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if known else "static").partitionBy("span").parquet(path)
    )


def follow(features: Table, path: str, ledger_path: str) -> dt.date | None:
    """Refresh what the gold job has dealt with since the last call; returns the day it began at, if any.

    A change reaches the return of its own day and of the symbol's next row, both of which are on or after it.
    """
    book = Ledger(features.spark, ledger_path)
    pending = book.pending(FOLLOWER, KEYS, upto=book.mark_of(GOLD))
    since = pending.changes.agg(F.min("date")).first()[0] if pending.changes is not None else None
    if since is not None:
        refresh(features, path, since)
    book.move(FOLLOWER, pending.mark)
    return since


def correlation(spark: SparkSession, path: str) -> DataFrame:
    """``symbol_a < symbol_b, correlation`` of daily returns over all stored spans."""
    return correlation_of(spark.read.schema(SPAN_SUMS).parquet(path))
