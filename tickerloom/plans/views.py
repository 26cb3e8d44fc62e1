"""Query views over the gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import labels
from ..operators.benchmark import benchmark_by_date, benchmarks_by_date
from ..operators.rank import Ranking, with_ranks
from ..settings import DEFAULT_SECTOR, Classification, Roles
from ..sources.tables import Table, rows_of

_CONTEXT = ["rsi_14", "dist_sma_50", "dist_sma_200", "drawdown_252d"]
_MACRO = ["cpi", "fedFundsRate", "treasury10y"]


def _date(as_of: dt.date | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def classified(df: DataFrame, classes: Classification | DataFrame) -> DataFrame:
    """Add ``asset_type`` and ``sector``.

    A short classification becomes a CASE. A large one is a table ``symbol, asset_type, sector``;
    symbols it leaves out get the defaults, and Spark broadcasts it only while it measures small.
    """
    symbol = F.col("symbol")
    if isinstance(classes, Classification):
        return df.withColumns({
            "asset_type": labels.asset_type(symbol, classes),
            "sector": labels.sector(symbol, classes),
        })
    once = classes.groupBy("symbol").agg(
        F.min("asset_type").alias("asset_type"), F.min("sector").alias("sector")
    )
    return df.join(once, "symbol", "left").withColumns({
        "asset_type": F.coalesce("asset_type", F.lit("STOCK")),
        "sector": F.coalesce("sector", F.lit(DEFAULT_SECTOR)),
    })


def _cutoff(as_of: dt.date | Column | None, months: int) -> Column:
    return F.add_months(_date(as_of), -months)


def daily_recent(
    features: DataFrame | Table,
    as_of: dt.date | Column | None = None,
    classes: Classification | DataFrame = Classification(),
    months: int = 24,
) -> DataFrame:
    """The last two years before ``as_of`` (today by default) with asset type and sector."""
    recent = rows_of(features, since=_cutoff(as_of, months))
    return classified(recent, classes).select(
        "symbol", "asset_type", "sector", "date", "close", "volume", "return_1d", "return_21d", "vol_ann_21d",
        *_CONTEXT, *_MACRO,
    )


def beside_benchmark(
    features: DataFrame | Table, roles: Roles = Roles(), as_of: dt.date | Column | None = None
) -> DataFrame:
    """``daily_recent`` next to the sector benchmark's returns; NULL where it has no row.

    One benchmark serves every sector unless ``roles.benchmark_of`` names others. Of a stored table the
    benchmarks' directories are read apart, without the others.
    """
    recent = daily_recent(features, as_of, roles.classes)
    symbols = sorted({roles.sector_benchmark, *roles.benchmark_of.values()})
    benchmarks = rows_of(features, symbols, _cutoff(as_of, 24))
    columns = {"return_1d": "sector_return_1d", "return_21d": "sector_return_21d"}
    if roles.benchmark_of:
        benchmark = F.lit(roles.sector_benchmark)
        for name, symbol in roles.benchmark_of.items():
            benchmark = F.when(F.col("sector") == name, symbol).otherwise(benchmark)
        lookup = benchmarks_by_date(benchmarks, symbols, columns)
        joined = recent.withColumn("benchmark", benchmark).join(
            lookup, ["benchmark", "date"], "left"
        )
    else:
        joined = recent.join(
            benchmark_by_date(benchmarks, roles.sector_benchmark, columns), "date", "left"
        )
    return joined.select(
        "symbol", "asset_type", "sector", "date", "close", "return_1d", "return_21d",
        "vol_ann_21d", *_CONTEXT, "sector_return_1d", "sector_return_21d",
        (F.col("return_1d") - F.col("sector_return_1d")).alias("alpha_1d"),
        (F.col("return_21d") - F.col("sector_return_21d")).alias("alpha_21d"),
        *_MACRO,
    )


def sector_comparison(
    features: DataFrame | Table, roles: Roles = Roles(), as_of: dt.date | Column | None = None
) -> DataFrame:
    return beside_benchmark(features, roles, as_of).orderBy(F.desc_nulls_last("date"), "symbol")


def leaderboard(
    summary: DataFrame, classes: Classification | DataFrame = Classification()
) -> DataFrame:
    """The snapshot with its place by one-month return and by lowest volatility, NULLs last."""
    ranked = with_ranks(summary, [
        Ranking("return_1m", "rank_return_1m", descending=True),
        Ranking("vol_ann_1m", "rank_lowest_vol"),
    ])
    return classified(ranked, classes).select(
        "symbol", "asset_type", "as_of_date", "last_close", "return_1m", "return_3m", "vol_ann_1m",
        "rsi_14", "drawdown_252d", "dist_sma_50", "dist_sma_200",
        "rank_return_1m", "rank_lowest_vol",
    ).orderBy(F.desc_nulls_last("return_1m"), "symbol")


def register_views(
    spark,
    silver: DataFrame,
    features: DataFrame | Table,
    summary: DataFrame,
    roles: Roles = Roles(),
    as_of: dt.date | Column | None = None,
) -> None:
    """Register the six views under the names SQL users query."""
    views = {
        "silver_price_with_macro": silver,
        "gold_daily_features": rows_of(features),
        "gold_symbol_summary": summary,
        "gold_daily_recent": daily_recent(features, as_of, roles.classes),
        "gold_sector_comparison": sector_comparison(features, roles, as_of),
        "gold_leaderboard": leaderboard(summary, roles.classes),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
