"""Backward as-of join of daily prices with slow macro series.

Each observation holds from its own day until the day before the series' next one. Spelling those
spans out gives a calendar keyed by day, so the as-of lookup is an equality join. Prices are
scanned once and never shuffled; days after the calendar's end look up its last day.

The calendar has one row per day between the first and the last observation, however large the
price table is. The DATE type itself ends at 3,652,059 days, about 120 MB of three series, which
is why it may be broadcast.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F


def _selected(observations: DataFrame, series: dict[str, str]) -> DataFrame:
    return observations.filter(
        F.col("series_id").isin(*series) & F.col("date").isNotNull() & F.col("value").isNotNull()
    )


def known_observations(observations: DataFrame, series: dict[str, str]) -> DataFrame:
    """One value per (series, day): the selected series, missing values left out, ties to the max."""
    selected = _selected(observations, series)
    return selected.groupBy("series_id", "date").agg(F.max("value").alias("value"))


def widen(long: DataFrame, series: dict[str, str]) -> DataFrame:
    """Long (series, date, value) to one row per date with a column per series, ties to the max.

    The pivot of a fixed list, written out: one exchange instead of the two of ``pivot``.
    """
    return long.groupBy("date").agg(*[
        F.max(F.when(F.col("series_id") == s, F.col("value"))).alias(name)
        for s, name in series.items()
    ])


def macro_wide(observations: DataFrame, series: dict[str, str]) -> DataFrame:
    return widen(_selected(observations, series), series)


def macro_calendar(observations: DataFrame, series: dict[str, str], end: Column | None = None) -> DataFrame:
    """Every day from the first to the last observation, or to ``end``, with the value known on that day.

    A window partition is one series, at most one row per day after ``known_observations``.
    """
    known = known_observations(observations, series)
    end = known.agg(F.max("date")).scalar() if end is None else end
    following = F.lead("date").over(Window.partitionBy("series_id").orderBy("date"))
    spans = known.withColumn("until", F.coalesce(F.date_sub(following, 1), end))
    days = spans.select("series_id", F.explode(F.sequence("date", "until")).alias("date"), "value")
    return widen(days, series)


def _published(observations: DataFrame, series: dict[str, str]) -> DataFrame:
    told = _selected(observations, series).filter(F.col("published").isNotNull())
    return told.withColumn("known_on", F.greatest("published", "date"))


def published_calendar(observations: DataFrame, series: dict[str, str]) -> DataFrame:
    """Every day from the first publication to the last with the value that was known on that day.

    ``observations`` have ``published`` besides: a value counts from the day it was published, or from its own
    day if that is later. Of what is known on a day the newest observation counts, in the version
    published last, ties to the larger value; a late revision of an older observation changes nothing. The
    newest is a running maximum over a series' publications, at most one row per day.
    """
    told = _published(observations, series)
    daily = told.groupBy("series_id", "known_on").agg(F.max(F.struct("date", "published", "value")).alias("newest"))
    order = Window.partitionBy("series_id").orderBy("known_on")
    known = daily.select(
        "series_id", "known_on", F.lead("known_on").over(order).alias("following"),
        F.max("newest").over(order.rowsBetween(Window.unboundedPreceding, 0))["value"].alias("value"))
    until = F.coalesce(F.date_sub("following", 1), told.agg(F.max("known_on")).scalar())
    return widen(known.select("series_id", F.explode(F.sequence("known_on", until)).alias("date"), "value"), series)


def join_asof(
    prices: DataFrame, observations: DataFrame, series: dict[str, str], point_in_time: bool = False
) -> DataFrame:
    """Add the last value of each series observed on or before the row's date, NULL before that.

    With ``point_in_time``, the value that was published by the row's date: no row sees an observation, or
    its revision, before the world did.
    """
    if point_in_time:
        calendar = published_calendar(observations, series)
        end = _published(observations, series).agg(F.max("known_on")).scalar()
    else:
        calendar = macro_calendar(observations, series)
        end = known_observations(observations, series).agg(F.max("date")).scalar()
    day = F.when(F.col("date") > end, end).otherwise(F.col("date"))
    placed = prices.select("*", day.alias("_day"))
    joined = placed.join(F.broadcast(calendar), placed["_day"] == calendar["date"], "left")
    return joined.select(*[placed[c] for c in prices.columns], *series.values())


def revised_days(old: DataFrame, new: DataFrame, series: dict[str, str]) -> tuple[DataFrame, date | None]:
    """``(day)`` on which the values known differ between two states of the observations, and the last
    day of both; the days after that one look up its values."""
    last = old.select("date").union(new.select("date")).agg(F.max("date")).first()[0]
    columns = list(series.values())
    before, after = (macro_calendar(some, series, F.lit(last).cast("date")) for some in (old, new))
    before = before.select(F.col("date").alias("_date"), *[F.col(c).alias(f"_{c}") for c in columns])
    both = after.join(before, F.col("date") == F.col("_date"), "full_outer")
    differ = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return both.filter(differ).select(F.coalesce("date", "_date").alias("day")), last
