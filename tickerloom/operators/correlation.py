"""Pairwise correlation of many series without joining the table to itself by date.

A self-join by date produces one row per pair and date. Here symbols are hashed into blocks and
dates cut into spans; each (block, block, span) group turns its rows into two small matrices whose
products give every pair's sums at once. Only one row per pair and span leaves a task, and Spark
combines those by the differences of their means. A group holds at most two blocks of symbols times
``DAYS`` dates. A row goes to as many groups as there are blocks, one per ``BLOCK`` symbols; name the
``symbols`` that matter when there are many thousands.

A correlation is NULL only where one of the series is constant on the pair's common days. Where the
products leave few digits of a pair's variance, the pair is computed again from its common days alone.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Python workers get this module's functions with the task; they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 128   # symbols per block
DAYS = 512    # calendar days per span
# Below this share of the sum of squares a variance has lost digits to cancellation.
DOUBTFUL = 1e-3

_PAIR_SUMS = (
    "symbol_a string, symbol_b string, n double, mean_a double, mean_b double, "
    "var_a double, var_b double, cov double, flat_a double, flat_b double"
)
SPAN_SUMS = f"{_PAIR_SUMS}, span long"


def _matrix(rows: pd.DataFrame, days: np.ndarray) -> tuple[np.ndarray, ...]:
    """Symbols x days: values, centred values with 0 where unknown, the known mask, names and centres."""
    names, row = np.unique(rows["symbol"].to_numpy(dtype=object), return_inverse=True)
    col = np.searchsorted(days, rows["day"].to_numpy())
    values = rows["value"].to_numpy(dtype=float)
    known = np.zeros((len(names), len(days)))
    known[row, col] = 1.0
    if known.sum() != len(rows):
        raise ValueError("correlation needs one row per symbol and date")
    centre = np.bincount(row, values) / np.bincount(row)
    plain, centred = np.zeros_like(known), np.zeros_like(known)
    plain[row, col], centred[row, col] = values, values - centre[row]
    return plain, centred, known, names, centre


def _pair_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    left_block, right_block = key[0], key[1]
    days = np.unique(rows["day"].to_numpy())
    x_known, x, mx, x_names, x_centre = _matrix(rows[rows["block"] == left_block], days)
    y_known, y, my, y_names, y_centre = _matrix(rows[rows["block"] == right_block], days)

    n = mx @ my.T
    wanted = n > 0
    if left_block == right_block:
        wanted &= np.triu(np.ones_like(wanted), k=1)
    a, b = np.nonzero(wanted)
    n = n[a, b]
    mean_a, mean_b = (x @ my.T)[a, b] / n, (mx @ y.T)[a, b] / n
    square_a, square_b = ((x * x) @ my.T)[a, b], (mx @ (y * y).T)[a, b]
    var_a, var_b = square_a - n * mean_a * mean_a, square_b - n * mean_b * mean_b
    cov = (x @ y.T)[a, b] - n * mean_a * mean_b
    mean_a, mean_b = mean_a + x_centre[a], mean_b + y_centre[b]
    flat_a, flat_b = np.full(len(a), np.nan), np.full(len(a), np.nan)
    for i in np.flatnonzero((var_a <= DOUBTFUL * square_a) | (var_b <= DOUBTFUL * square_b)):
        both = (mx[a[i]] > 0) & (my[b[i]] > 0)
        one, two = x_known[a[i], both], y_known[b[i], both]
        mean_a[i], mean_b[i] = one.mean(), two.mean()
        if one.min() == one.max():
            flat_a[i] = mean_a[i] = one[0]
        if two.min() == two.max():
            flat_b[i] = mean_b[i] = two[0]
        one, two = one - mean_a[i], two - mean_b[i]
        var_a[i], var_b[i], cov[i] = one @ one, two @ two, one @ two

    out = pd.DataFrame({
        "symbol_a": x_names[a],
        "symbol_b": y_names[b],
        "n": n,
        "mean_a": mean_a,
        "mean_b": mean_b,
        "var_a": var_a,
        "var_b": var_b,
        "cov": cov,
        "flat_a": flat_a,
        "flat_b": flat_b,
    })
    swap = out["symbol_a"] > out["symbol_b"]
    for name in ("symbol", "mean", "var", "flat"):
        first, second = f"{name}_a", f"{name}_b"
        out.loc[swap, [first, second]] = out.loc[swap, [second, first]].to_numpy()
    return out


def _span_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return _pair_sums(key, rows).assign(span=key[2])


def pairwise_correlation(
    df: DataFrame,
    value: str,
    blocks: int | None = None,
    days: int = DAYS,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """``symbol_a < symbol_b, correlation`` for every pair with a common date, from its sums by span."""
    return correlation_of(span_sums(df, value, blocks, days, symbols))


def span_sums(
    df: DataFrame,
    value: str,
    blocks: int | None = None,
    days: int = DAYS,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """``span`` and what every pair's rows of that span come to; spans are of ``days`` days since 1970.

    ``df`` has one row per (symbol, date); rows without a value take no part. ``blocks`` defaults
    to one per ``BLOCK`` symbols: of ``symbols`` if they are named, else counted with one narrow
    aggregate. The number changes how the work is cut, not the result.
    """
    known = df.filter(F.col(value).isNotNull() & F.col("symbol").isNotNull()).select(
        "symbol", F.unix_date("date").alias("day"), F.col(value).alias("value")
    )
    if symbols is not None:
        known = known.filter(F.col("symbol").isin(*symbols))
    if blocks is None:
        count = len(symbols) if symbols is not None else known.agg(F.approx_count_distinct("symbol")).head()[0]
        blocks = max(1, math.ceil(count / BLOCK))

    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = (
        known
        .withColumn("block", F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int"))
        .withColumn("other", other)
        .withColumn("left_block", F.least("block", "other"))
        .withColumn("right_block", F.greatest("block", "other"))
        .withColumn("span", F.floor(F.col("day") / days))
        .drop("other")
    )
    return placed.groupBy("left_block", "right_block", "span").applyInPandas(_span_sums, SPAN_SUMS)


def correlation_of(sums: DataFrame) -> DataFrame:
    """``symbol_a < symbol_b, correlation`` from sums by span, of which each pair has one a span."""
    # One element per span: as many as the calendar has.
    spans = sums.groupBy("symbol_a", "symbol_b").agg(F.collect_list(F.struct(
        "n", "mean_a", "mean_b", "var_a", "var_b", "cov", "flat_a", "flat_b"
    )).alias("spans"))

    def added(term: Callable[[Column], Column]) -> Column:
        return F.aggregate("spans", F.lit(0.0), lambda total, s: total + term(s))

    means = spans.withColumns({
        name: added(lambda s, name=name: s["n"] * s[name]) / added(lambda s: s["n"])
        for name in ("mean_a", "mean_b")
    })
    off = {name: (lambda s, name=name: s[name] - F.col(name)) for name in ("mean_a", "mean_b")}

    def flat(name: str) -> Column:
        first = F.col("spans")[0][name]
        return F.coalesce(F.forall("spans", lambda s: s[name] == first), F.lit(False))   # NULL: not flat

    def spread(var: str, mean: str) -> Column:
        return F.sqrt(added(lambda s: s[var] + s["n"] * off[mean](s) * off[mean](s)))

    cov = added(lambda s: s["cov"] + s["n"] * off["mean_a"](s) * off["mean_b"](s))
    size = spread("var_a", "mean_a") * spread("var_b", "mean_b")
    return means.select(
        "symbol_a", "symbol_b",
        F.when(~flat("flat_a") & ~flat("flat_b") & (size > 0), cov / size).alias("correlation"),
    )
