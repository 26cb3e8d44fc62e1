"""Benchmark symbols' columns as a lookup keyed by date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _lookup(rows: DataFrame, key: Sequence[str], columns: dict[str, str], what: str) -> DataFrame:
    """``columns`` (old to new name), one row per ``key``, ready to broadcast.

    Grouping bounds the lookup by the number of days. A repeated key would change every result
    joined to it, so it raises rather than picking a row.
    """
    def only(name: str):
        repeated = F.raise_error(F.lit(f"benchmark {what} has more than one row on a date"))
        return F.when(F.count(F.lit(1)) > 1, repeated.cast("double")).otherwise(F.max(name))

    return F.broadcast(
        rows.groupBy(*key).agg(*[only(old).alias(new) for old, new in columns.items()])
    )


def benchmark_by_date(features: DataFrame, symbol: str, columns: dict[str, str]) -> DataFrame:
    """``date`` and the columns of one benchmark."""
    return _lookup(features.filter(F.col("symbol") == symbol), ["date"], columns, symbol)


def benchmarks_by_date(
    features: DataFrame, symbols: Sequence[str], columns: dict[str, str]
) -> DataFrame:
    """``benchmark``, ``date`` and the columns of a few benchmarks."""
    rows = features.filter(F.col("symbol").isin(*symbols))
    return _lookup(
        rows.withColumn("benchmark", F.col("symbol")), ["benchmark", "date"], columns,
        ", ".join(symbols),
    )
