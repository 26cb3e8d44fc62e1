"""Schemas of the landed documents and of the typed tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.DoubleType()) for name in names]


CORRUPT = "_corrupt_record"

# Landed price document. The last four leaves only appear in an error answer or a broken file.
PRICE_DOCUMENT = T.StructType([
    T.StructField("meta", T.StructType(_strings("symbol"))),
    T.StructField("values", T.ArrayType(T.StructType(
        _strings("datetime", "open", "high", "low", "close", "volume")
    ))),
    *_strings("status", "code", "message", CORRUPT),
])

MACRO_DOCUMENT = T.StructType([
    T.StructField("observations", T.ArrayType(T.StructType(_strings("date", "value")))),
    *_strings(CORRUPT),
])

KEY = ["symbol", "date"]

PRICES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    *_doubles("open", "high", "low", "close"),
    T.StructField("volume", T.LongType()),
])

OBSERVATIONS = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("date", T.DateType()),
    *_doubles("value"),
])

# The names and order of the feature columns.
RETURNS = ["return_1d", "return_5d", "return_21d", "return_63d"]
TREND = ["sma_20", "sma_50", "sma_200", "dist_sma_20", "dist_sma_50", "dist_sma_200"]
VOLATILITY = ["vol_21d", "vol_63d", "vol_ann_21d"]
MACRO_CHANGES = ["cpi_chg_1m", "fed_funds_chg", "treasury10y_chg"]
FEATURES = [
    *RETURNS, *TREND, *VOLATILITY, "volume_rel_20d", "rsi_14", "drawdown_252d", *MACRO_CHANGES,
]


def silver(macro_columns: list[str]) -> T.StructType:
    return T.StructType([*PRICES.fields, *_doubles(*macro_columns)])


def gold(macro_columns: list[str]) -> T.StructType:
    return T.StructType([*silver(macro_columns).fields, *_doubles(*FEATURES)])
