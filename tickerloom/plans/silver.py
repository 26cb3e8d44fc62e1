"""Typed prices with the macro values known on each trading day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.asof import join_asof
from ..schemas import PRICES
from ..settings import DEFAULT_SERIES, macro_columns


def price_with_macro(
    prices: DataFrame,
    observations: DataFrame,
    series: dict[str, str] = DEFAULT_SERIES,
    point_in_time: bool = False,
) -> DataFrame:
    """One row per price row; days before a series starts, and series left out, keep NULL."""
    absent = F.lit(None).cast("double")
    known = set(series.values())
    return join_asof(prices, observations, series, point_in_time).select(
        *PRICES.names,
        *[name if name in known else absent.alias(name) for name in macro_columns(series)],
    )
