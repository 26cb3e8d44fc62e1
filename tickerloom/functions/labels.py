"""Category columns: asset type, sector, rate regime and screens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..settings import Classification

# Regime names and screen thresholds.
REGIMES = ["easing", "stable", "tightening"]
EVENT_VOLUME = 2.0
EVENT_MOVE = 0.03
RSI_LOW = 30
RSI_HIGH = 70
FAR_FROM_AVERAGE = 0.10
BAD_DAY = -0.01


def asset_type(symbol: Column, classes: Classification) -> Column:
    return F.when(symbol.isin(*classes.etfs), "ETF").otherwise("STOCK")


def sector(symbol: Column, classes: Classification) -> Column:
    label = F.lit(classes.default_sector)
    for name, members in reversed(classes.sectors):
        label = F.when(symbol.isin(*members), name).otherwise(label)
    return label


def rate_regime(change: Column) -> Column:
    easing, stable, tightening = REGIMES
    return F.when(change > 0, tightening).when(change < 0, easing).otherwise(stable)


def is_event(volume_rel: Column, daily_return: Column) -> Column:
    return (volume_rel > EVENT_VOLUME) & (F.abs(daily_return) > EVENT_MOVE)


def is_stretched(rsi: Column, distance: Column) -> Column:
    return ((rsi < RSI_LOW) | (rsi > RSI_HIGH)) & (F.abs(distance) > FAR_FROM_AVERAGE)


def is_bad_day(market_return: Column) -> Column:
    return market_return < BAD_DAY
