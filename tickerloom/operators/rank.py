"""Global RANK without sorting a large table in one task.

Equal values are first collapsed to one row with a count, which also removes any hot value. The
distinct values are dealt to slices by range and kept with their slice. A value's rank is then one
plus the rows in better slices plus the better rows of its own slice. Where slices end only balances
the work; the rank is exact wherever that is.

A table counted to be small, such as a snapshot with a row per symbol, is ranked with a plain window
instead: one task sorts ``ONE_TASK`` rows sooner than the slices are written. Both give the same ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

ONE_TASK = 100_000   # rows that a single task may sort
PER_SLICE = 1_000_000   # distinct values in a slice
LEAST_SLICES = 64


class Ranking(NamedTuple):
    """RANK() over all rows by ``value``, NULL values last, as column ``name``."""

    value: str
    name: str
    descending: bool = False


def with_ranks(df: DataFrame, rankings: Sequence[Ranking], one_task: int = ONE_TASK) -> DataFrame:
    """Add every ranking. ``df`` should be a stored table: its rows are counted first."""
    if df.limit(one_task + 1).count() <= one_task:
        return df.withColumns({r.name: _plain(r) for r in rankings})
    for ranking in rankings:
        df = sliced_rank(df, ranking)
    return df


def _plain(ranking: Ranking) -> Column:
    order = F.desc_nulls_last if ranking.descending else F.asc_nulls_last
    return F.rank().over(Window.orderBy(order(ranking.value))).cast("bigint")


def sliced_rank(df: DataFrame, ranking: Ranking, slices: int | None = None) -> DataFrame:
    """Add one ranking with no task seeing more than a slice of the distinct values.

    ``slices`` defaults to what an approximate count of the distinct values asks for. A value that
    many rows share is one row here; the join back to those rows is left to AQE skew splitting.
    """
    value, rank, descending = ranking
    if slices is None:
        distinct = df.agg(F.approx_count_distinct(value)).head()[0]
        slices = max(distinct // PER_SLICE, LEAST_SLICES)
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    better = F.desc_nulls_last if descending else F.asc_nulls_last
    # Written once: the ends of the ranges are sampled, and both uses below must see the same.
    sliced = stage(
        counts.repartitionByRange(slices, better("_value")).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )

    earlier = (Window.unboundedPreceding, -1)
    per_slice = sliced.groupBy("_slice").agg(F.sum("_rows").alias("_slice_rows"))
    offsets = per_slice.select(   # at most a row per slice
        "_slice",
        F.coalesce(
            F.sum("_slice_rows").over(Window.orderBy("_slice").rowsBetween(*earlier)), F.lit(0)
        ).alias("_offset"),
    )
    inside = Window.partitionBy("_slice").orderBy(better("_value")).rowsBetween(*earlier)
    ranks = sliced.join(offsets, "_slice").select(
        "_value",
        (F.col("_offset") + F.coalesce(F.sum("_rows").over(inside), F.lit(0)) + 1).alias(rank),
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")
