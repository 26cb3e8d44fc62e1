"""The data behind each chart, shaped in Spark and ready to draw."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import labels
from ..settings import MARKET_PROXY, Roles
from ..sources.tables import Table, rows_of
from . import analytics


def returns_wide(features: DataFrame | Table, symbols: Sequence[str]) -> DataFrame:
    """A row per date and a column per symbol. Naming the symbols spares a pass to find them."""
    return (
        rows_of(features).filter(F.col("return_1d").isNotNull())
        .groupBy("date")
        .pivot("symbol", list(symbols))
        .agg(F.first("return_1d"))
    )


def correlation_matrix(features: DataFrame | Table, symbols: Sequence[str] | None = None) -> DataFrame:
    """The strict lower triangle: row symbol after column symbol."""
    return analytics.return_pairs(features, symbols).select(
        F.col("symbol_b").alias("row_symbol"), F.col("symbol_a").alias("column_symbol"),
        "correlation",
    )


def correlation_range(features: DataFrame | Table, symbols: Sequence[str] | None = None) -> DataFrame:
    """Smallest and largest off-diagonal correlation, the bounds of the colour scale."""
    return analytics.return_pairs(features, symbols).agg(
        F.min("correlation").alias("min_correlation"),
        F.max("correlation").alias("max_correlation"),
    )


def beta_flagged(features: DataFrame | Table, market: str = MARKET_PROXY) -> DataFrame:
    beta = analytics.capm_beta(features, market).select("symbol", "beta")
    return beta.withColumn("above_market", F.coalesce(F.col("beta") > 1, F.lit(False)))


def regime_wide(features: DataFrame | Table) -> DataFrame:
    """A row per symbol and a column per regime."""
    return (
        analytics.regime_averages(features)
        .groupBy("symbol")
        .pivot("regime", labels.REGIMES)
        .agg(F.first("avg_return"))
    )


def alpha_flagged(
    features: DataFrame | Table, roles: Roles = Roles(), as_of: dt.date | Column | None = None
) -> DataFrame:
    alpha = analytics.sector_alpha(features, roles, as_of)
    return alpha.withColumn("positive", F.coalesce(F.col("avg_daily_alpha") > 0, F.lit(False)))


def event_labels(features: DataFrame | Table) -> DataFrame:
    """Every day with a known volume ratio and return, labelled instead of filtered."""
    volume, move = F.col("volume_rel_20d"), F.col("return_1d")
    return rows_of(features).filter(volume.isNotNull() & move.isNotNull()).select(
        "symbol", "date", "return_1d", "volume_rel_20d",
        labels.is_event(volume, move).alias("is_event"),
    )


def bad_day_returns(features: DataFrame | Table, market: str = MARKET_PROXY) -> DataFrame:
    return analytics.tail_risk(features, market).select(
        "symbol", F.col("avg_return_on_bad_market_days").alias("avg_return_on_bad_days")
    )
