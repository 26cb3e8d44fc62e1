"""Analytical queries over the daily features.

Results are sorted by their leading column and then by key: with the key in the ordering, Spark can
divide a run of equal values, such as one busy date, between sort tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import guarded, labels
from ..operators.benchmark import benchmark_by_date
from ..operators.correlation import pairwise_correlation
from ..settings import MARKET_PROXY, Roles
from ..sources.tables import Table, rows_of
from .views import beside_benchmark


def beside_market(features: DataFrame | Table, market: str) -> DataFrame:
    """Every other symbol's return next to the market's on the same day."""
    proxy = benchmark_by_date(rows_of(features, [market]), market, {"return_1d": "market_return"})
    assets = rows_of(features).filter(F.col("symbol") != market).select("symbol", "date", "return_1d")
    return assets.join(proxy, "date")


def return_pairs(features: DataFrame | Table, symbols: Sequence[str] | None = None) -> DataFrame:
    """Correlation of daily returns for every pair of ``symbols``, by default of all."""
    return pairwise_correlation(rows_of(features, symbols), "return_1d", symbols=symbols)


def return_correlation(features: DataFrame | Table, symbols: Sequence[str] | None = None) -> DataFrame:
    """``return_pairs``, highest first."""
    return return_pairs(features, symbols).orderBy(
        F.desc_nulls_last("correlation"), "symbol_a", "symbol_b"
    )


def capm_beta(features: DataFrame | Table, market: str = MARKET_PROXY) -> DataFrame:
    """Beta, correlation with the market and average excess return.

    Each statistic keeps its own population: the covariance and the correlation use days on which
    both returns are known, the market's variance and average every joined day it is known.
    """
    own, proxy = F.col("return_1d"), F.col("market_return")
    return beside_market(features, market).groupBy("symbol").agg(
        guarded.beta(own, proxy).alias("beta"),
        guarded.correlation(own, proxy).alias("correlation_to_spy"),
        (F.avg(own) - F.avg(proxy)).alias("naive_alpha"),
    ).orderBy(F.desc_nulls_last("beta"), "symbol")


def regime_averages(features: DataFrame | Table) -> DataFrame:
    return (
        rows_of(features).filter(F.col("fed_funds_chg").isNotNull())
        .groupBy("symbol", labels.rate_regime(F.col("fed_funds_chg")).alias("regime"))
        .agg(F.avg("return_1d").alias("avg_return"), F.count(F.lit(1)).alias("days"))
    )


def rate_regime(features: DataFrame | Table) -> DataFrame:
    """Average return and number of days by direction of the policy rate.

    The rate only moves on the first trading row after an observation, so nearly every day is
    'stable'. Days without a return count, but do not enter the average.
    """
    return regime_averages(features).orderBy("symbol", "regime")


def sector_alpha(
    features: DataFrame | Table, roles: Roles = Roles(), as_of: dt.date | Column | None = None
) -> DataFrame:
    """Mean and deviation of the daily return in excess of the sector benchmark."""
    return beside_benchmark(features, roles, as_of).groupBy("symbol").agg(
        F.avg("alpha_1d").alias("avg_daily_alpha"),
        F.stddev_samp("alpha_1d").alias("alpha_volatility"),
    ).orderBy(F.desc_nulls_last("avg_daily_alpha"), "symbol")


def event_screen(features: DataFrame | Table) -> DataFrame:
    """Days with both unusual volume and an unusual move."""
    return (
        rows_of(features).filter(labels.is_event(F.col("volume_rel_20d"), F.col("return_1d")))
        .select("symbol", "date", "close", "return_1d", "volume_rel_20d", "vol_ann_21d")
        .orderBy(F.desc_nulls_last("volume_rel_20d"), "symbol", "date")
    )


def mean_reversion(features: DataFrame | Table) -> DataFrame:
    """Days with an extreme RSI far from the 50-day average."""
    return (
        rows_of(features).filter(labels.is_stretched(F.col("rsi_14"), F.col("dist_sma_50")))
        .select("symbol", "date", "close", "rsi_14", "dist_sma_50", "dist_sma_200")
        .orderBy(F.desc_nulls_last("date"), "symbol")
    )


def tail_risk(features: DataFrame | Table, market: str = MARKET_PROXY) -> DataFrame:
    """Average return on the market's bad days; symbols without one keep NULL and 0."""
    bad = labels.is_bad_day(F.col("market_return"))
    return beside_market(features, market).groupBy("symbol").agg(
        F.avg(F.when(bad, F.col("return_1d"))).alias("avg_return_on_bad_market_days"),
        F.count_if(bad).alias("bad_days"),
    ).orderBy(F.asc_nulls_last("avg_return_on_bad_market_days"), "symbol")
