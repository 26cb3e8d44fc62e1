"""Technical indicators as window expressions over one symbol's rows in date order.

Frames count rows, not days, and are partial during warm-up: an average over 200 rows exists on
row 1. All of them share one partitioning and ordering, so Spark needs a single exchange and sort.

Spark evaluates a sliding frame anew for every row, so a 252-row maximum costs 252 steps per row.
The longest frames are therefore put together from shorter ones: the maximum over 252 rows is the
largest of the 63-row maxima found 0, 63, 126 and 189 rows back. Rows before a symbol's first yield
no short frame, which is exactly the partial frame of the warm-up.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, Window, WindowSpec, functions as F

from .guarded import growth, ratio

TRADING_DAYS = 252


def history() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def trailing(w: WindowSpec, rows: int) -> WindowSpec:
    """The current row and the ``rows - 1`` before it."""
    return w.rowsBetween(1 - rows, Window.currentRow)


def before(w: WindowSpec, column: str, rows: int) -> Column:
    return F.lag(column, rows).over(w)


def return_over(w: WindowSpec, rows: int) -> Column:
    return growth(F.col("close"), before(w, "close", rows))


def moving_average(w: WindowSpec, column: str, rows: int) -> Column:
    return F.avg(column).over(trailing(w, rows))


def volatility(w: WindowSpec, returns: str, rows: int) -> Column:
    """Sample deviation; NULL while fewer than two returns are known."""
    return F.stddev_samp(returns).over(trailing(w, rows))


def frames(w: WindowSpec, column: str, rows: int, times: int) -> list[Column]:
    """A short-frame result of this row and of the rows 1, 2, ... frames back."""
    return [F.col(column)] + [before(w, column, rows * n) for n in range(1, times)]


def total(w: WindowSpec, column: str, rows: int, times: int) -> Column:
    """Sum over ``rows * times`` rows from sums over ``rows`` rows."""
    return reduce(add, [F.coalesce(part, F.lit(0)) for part in frames(w, column, rows, times)])


def highest(w: WindowSpec, column: str, rows: int, times: int) -> Column:
    """Maximum over ``rows * times`` rows from maxima over ``rows`` rows."""
    return F.greatest(*frames(w, column, rows, times))


def annualised(daily: Column) -> Column:
    return daily * F.sqrt(F.lit(TRADING_DAYS))


def gain_and_loss(move: Column) -> tuple[Column, Column]:
    """Upward and downward part of a move; an unknown move counts as none."""
    return F.when(move > 0, move).otherwise(0.0), F.when(move < 0, -move).otherwise(0.0)


def relative_strength(avg_gain: Column, avg_loss: Column) -> Column:
    """Simple-average RSI; 100 when nothing was lost, so it is never NULL."""
    index = F.lit(100) - F.lit(100) / (F.lit(1) + ratio(avg_gain, avg_loss))
    return F.when(avg_loss == 0, 100.0).otherwise(index)


def drawdown(close: Column, peak: Column) -> Column:
    return growth(close, peak)
