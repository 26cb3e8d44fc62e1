"""Quality checks. Each counts violations; none fails a job unless asked to.

All checks of a suite share one pass. Rows are reduced to one per key, with their violations
summed, in each scan task first, so a heavily repeated key does not pile up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, functions as F

from ..schemas import KEY

PRICE_COLUMNS = ["open", "high", "low", "close"]


@dataclass(frozen=True)
class RowCheck:
    """Counts the rows for which ``violated`` holds; NULL counts as not violated."""

    name: str
    violated: Column


@dataclass(frozen=True)
class KeyCheck:
    """Counts the keys that occur more than once."""

    key: Sequence[str]

    @property
    def name(self) -> str:
        return f"no_duplicates_in({','.join(self.key)})"


def no_nulls_in(columns: Sequence[str]) -> RowCheck:
    return RowCheck(
        f"no_nulls_in({','.join(columns)})", reduce(or_, [F.col(c).isNull() for c in columns])
    )


def no_duplicates_in(key: Sequence[str]) -> KeyCheck:
    return KeyCheck(tuple(key))


def positive_prices() -> RowCheck:
    return RowCheck("positive_prices", reduce(or_, [F.col(c) <= 0 for c in PRICE_COLUMNS]))


def high_greater_or_equal_low() -> RowCheck:
    return RowCheck("high_greater_or_equal_low", F.col("high") < F.col("low"))


def non_negative_volume() -> RowCheck:
    return RowCheck("non_negative_volume", F.col("volume") < 0)


def report(df: DataFrame, unique: KeyCheck, rows: Sequence[RowCheck]) -> DataFrame:
    """One row per check: ``check, violating_rows, passed, status``."""
    per_key = df.groupBy(*unique.key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(check.violated).alias(f"_c{i}") for i, check in enumerate(rows)],
    )
    totals = per_key.agg(
        F.count_if(F.col("_rows") > 1).alias("_duplicates"),
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(rows))],
    )
    counted = [(unique.name, "_duplicates")] + [(c.name, f"_c{i}") for i, c in enumerate(rows)]
    results = F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(column).alias("violating_rows"))
        for name, column in counted
    ])
    passed = F.col("violating_rows") == 0
    failed = F.format_string("FAILED (%d rows)", F.col("violating_rows"))
    return totals.select(F.inline(results)).select(
        "check", "violating_rows",
        passed.alias("passed"),
        F.when(passed, "OK").otherwise(failed).alias("status"),
    )


def _price_checks() -> list[RowCheck]:
    return [
        no_nulls_in([*KEY, *PRICE_COLUMNS]),
        positive_prices(),
        high_greater_or_equal_low(),
        non_negative_volume(),
    ]


def silver_quality(prices: DataFrame) -> DataFrame:
    """Checks on the typed prices; the macro columns may be NULL."""
    return report(prices, no_duplicates_in(KEY), _price_checks())


def judged(prices: DataFrame) -> DataFrame:
    """``prices`` with the names of the silver checks that a row fails in ``failed_checks``, empty for a good
    row. All rows of a repeated key fail, since none is known to be the right one."""
    key = no_duplicates_in(KEY)
    repeated = prices.groupBy(*KEY).count().filter("count > 1").select(*[F.col(k).alias(f"_{k}") for k in KEY], F.lit(True).alias("_repeated"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY])
    violations = [(key.name, F.col("_repeated")), *[(c.name, c.violated) for c in _price_checks()]]
    failed = F.array_compact(F.array(*[F.when(violated, F.lit(name)) for name, violated in violations]))
    return prices.join(repeated, same, "left").select(*prices.columns, failed.alias("failed_checks"))


def gold_quality(features: DataFrame) -> DataFrame:
    return report(features, no_duplicates_in(KEY), [
        no_nulls_in([*KEY, "close"]), positive_prices(),
    ])


class QualityError(RuntimeError):
    """A strict run met a failed check."""


def enforce(results: DataFrame | list[Row], strict: bool = False) -> list[str]:
    """Lines of the report, one per check; a strict run raises on the first failed suite."""
    rows = results.collect() if isinstance(results, DataFrame) else results   # one row per check
    lines = [f"{row['check']}: {row['status']}" for row in rows]
    if strict and not all(row["passed"] for row in rows):
        raise QualityError("; ".join(lines))
    return lines


def unique(results: list[Row]) -> bool:
    """Whether the suite found every key once."""
    return all(row["passed"] for row in results if row["check"] == no_duplicates_in(KEY).name)
