"""Daily features and the latest snapshot per symbol.

A symbol has one row per day (the writers refuse repeated keys), so a window partition is bounded
by the calendar, a few megabytes per century, no matter how the table grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import schemas
from ..functions import technical as ta
from ..functions.guarded import growth, ratio

LOOK_BACK = 252   # rows before a day that its features can depend on


def daily_features(silver: DataFrame) -> DataFrame:
    """Silver's columns followed by the technical and macro features.

    Two windows over the same sorted rows. The second adds what needs returns or moves, and the
    200- and 252-row frames, which it puts together from the first one's 50- and 63-row frames.
    """
    col, w = F.col, ta.history()
    first = silver.select(
        "*",
        (col("close") - ta.before(w, "close", 1)).alias("move"),
        *[ta.return_over(w, n).alias(f"return_{n}d") for n in (1, 5, 21, 63)],
        ta.moving_average(w, "close", 20).alias("sma_20"),
        F.sum("close").over(ta.trailing(w, 50)).alias("close_50"),
        F.count("close").over(ta.trailing(w, 50)).alias("closes_50"),
        ta.moving_average(w, "volume", 20).alias("usual_volume"),
        F.max("high").over(ta.trailing(w, 63)).alias("high_63"),
        growth(col("cpi"), ta.before(w, "cpi", 21)).alias("cpi_chg_1m"),
        (col("fedFundsRate") - ta.before(w, "fedFundsRate", 1)).alias("fed_funds_chg"),
        (col("treasury10y") - ta.before(w, "treasury10y", 1)).alias("treasury10y_chg"),
    )
    gain, loss = ta.gain_and_loss(col("move"))
    second = first.select(
        *silver.columns, *schemas.RETURNS, "sma_20",
        ratio(col("close_50"), col("closes_50")).alias("sma_50"),
        ratio(ta.total(w, "close_50", 50, 4), ta.total(w, "closes_50", 50, 4)).alias("sma_200"),
        *[ta.volatility(w, "return_1d", n).alias(f"vol_{n}d") for n in (21, 63)],
        ratio(col("volume"), col("usual_volume")).alias("volume_rel_20d"),
        F.avg(gain).over(ta.trailing(w, 14)).alias("avg_gain"),
        F.avg(loss).over(ta.trailing(w, 14)).alias("avg_loss"),
        ta.highest(w, "high_63", 63, 4).alias("peak"),
        *schemas.MACRO_CHANGES,
    )
    return second.select(
        *silver.columns,
        *schemas.RETURNS,
        "sma_20", "sma_50", "sma_200",
        *[growth(col("close"), col(f"sma_{n}")).alias(f"dist_sma_{n}") for n in (20, 50, 200)],
        "vol_21d", "vol_63d",
        ta.annualised(col("vol_21d")).alias("vol_ann_21d"),
        "volume_rel_20d",
        ta.relative_strength(col("avg_gain"), col("avg_loss")).alias("rsi_14"),
        ta.drawdown(col("close"), col("peak")).alias("drawdown_252d"),
        *schemas.MACRO_CHANGES,
    )


def symbol_summary(features: DataFrame) -> DataFrame:
    """Each symbol's latest row. Spark keeps one row per symbol and task before the shuffle."""
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
    return (
        features.withColumn("_place", newest)
        .filter(F.col("_place") == 1)
        .select(
            "symbol",
            F.col("date").alias("as_of_date"),
            F.col("close").alias("last_close"),
            F.col("return_21d").alias("return_1m"),
            F.col("return_63d").alias("return_3m"),
            F.col("vol_ann_21d").alias("vol_ann_1m"),
            "rsi_14", "drawdown_252d", "dist_sma_50", "dist_sma_200",
            "cpi", "fedFundsRate", "treasury10y",
        )
    )
