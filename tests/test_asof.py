"""Backward as-of join against the table in the fixtures and a day-by-day fill."""

import random
import re
from datetime import date, timedelta

from conftest import as_dicts, jan
from tickerloom import schemas
from tickerloom.operators import asof
from tickerloom.plans.silver import price_with_macro

SERIES = {"X": "x", "Y": "y"}


def test_fixture_table(spark, make_prices):
    observed = spark.createDataFrame(
        [("X", jan(3), 1.0), ("X", jan(4), None), ("X", jan(8), 2.0), ("Y", jan(1), 9.0),
         ("Z", jan(5), 7.0)], schemas.OBSERVATIONS)
    prices = make_prices([("A", jan(d), 1.0) for d in (2, 3, 5, 8, 10)])
    rows = as_dicts(asof.join_asof(prices, observed, SERIES), "date")
    assert [(r["x"], r["y"]) for r in rows] == [(None, 9), (1, 9), (1, 9), (2, 9), (2, 9)]


def test_repeated_observation_takes_the_max(spark, make_prices):
    observed = spark.createDataFrame(
        [("X", jan(1), 1.0), ("X", jan(1), 3.0), ("X", jan(1), 2.0)], schemas.OBSERVATIONS)
    rows = asof.join_asof(make_prices([("A", jan(1), 1.0)]), observed, SERIES).collect()
    assert [(r["x"], r["y"]) for r in rows] == [(3.0, None)]
    assert asof.macro_wide(observed, SERIES).collect()[0]["x"] == 3.0


def test_prices_before_the_first_observation_or_without_any(spark, make_prices):
    prices = make_prices([("A", jan(1), 1.0), ("A", None, 1.0)])
    later = spark.createDataFrame([("X", jan(9), 1.0)], schemas.OBSERVATIONS)
    for observed in (later, later.limit(0)):
        rows = asof.join_asof(prices, observed, SERIES).collect()
        assert [(r["x"], r["y"]) for r in rows] == [(None, None)] * 2


def test_equals_a_day_by_day_fill(spark, make_prices):
    rng = random.Random(11)
    start = date(2020, 1, 1)
    for _ in range(3):
        points = {(s, start + timedelta(rng.randrange(300))): float(rng.randrange(100))
                  for s in SERIES for _ in range(rng.randrange(1, 25))}
        days = sorted({start + timedelta(rng.randrange(-30, 400)) for _ in range(120)})
        observed = spark.createDataFrame(
            [(s, d, v) for (s, d), v in points.items()], schemas.OBSERVATIONS)
        prices = make_prices([(symbol, d, 1.0) for d in days for symbol in "AB"])
        got = as_dicts(asof.join_asof(prices, observed, SERIES), "date", "symbol")
        assert len(got) == 2 * len(days)
        for row in got:
            for series, column in SERIES.items():
                past = [d for s, d in points if s == series and d <= row["date"]]
                assert row[column] == (points[series, max(past)] if past else None)


def test_silver_keeps_standard_columns_and_adds_others(spark, make_prices):
    observed = spark.createDataFrame([("GDP", jan(1), 5.0)], schemas.OBSERVATIONS)
    df = price_with_macro(make_prices([("A", jan(2), 1.0)]), observed, {"GDP": "gdp"})
    assert df.columns[7:] == ["cpi", "fedFundsRate", "treasury10y", "gdp"]
    assert df.collect()[0]["gdp"] == 5.0 and df.collect()[0]["cpi"] is None


def test_prices_are_neither_shuffled_nor_scanned_twice(spark, make_prices, tmp_path):
    path = str(tmp_path / "prices")
    make_prices([("A", jan(2), 1.0)]).write.parquet(path)
    observed = spark.createDataFrame([("X", jan(1), 5.0)], schemas.OBSERVATIONS)
    df = asof.join_asof(spark.read.parquet(path), observed, SERIES)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
    # Only the macro side is shuffled; a shuffle of the prices would be by their lookup day.
    assert set(re.findall(r"hashpartitioning\((\w+)#", physical)) == {"series_id", "date"}


VINTAGES = "series_id string, date date, value double, published date"


def test_no_revision_is_seen_before_its_publication(spark, make_prices):
    told = spark.createDataFrame([
        ("X", jan(1), 1.0, jan(4)), ("X", jan(1), 1.5, jan(8)), ("X", jan(5), 2.0, jan(7)), ("X", jan(5), 2.5, jan(10)),
        ("X", jan(12), 3.0, jan(11)),                                  # published ahead of its day
        ("X", jan(6), None, jan(6)), ("X", jan(6), 9.0, None), ("X", None, 9.0, jan(6)), ("Z", jan(1), 9.0, jan(1)),
        ("Y", jan(2), 5.0, jan(2)), ("Y", jan(2), 6.0, jan(2))], VINTAGES)
    prices = make_prices([("A", jan(d), 1.0) for d in range(1, 16)])
    rows = as_dicts(asof.join_asof(prices, told, SERIES, point_in_time=True), "date")
    assert [r["x"] for r in rows] == [None, None, None, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 2.5, 2.5, 3.0, 3.0, 3.0, 3.0]
    assert [r["y"] for r in rows] == [None] + [6.0] * 14
    silver = price_with_macro(prices, told, SERIES, point_in_time=True)
    assert "x" in silver.columns and silver.count() == 15
    assert asof.join_asof(prices, told.limit(0), SERIES, point_in_time=True).filter("x IS NULL AND y IS NULL").count() == 15


def test_point_in_time_equals_a_search_day_by_day(spark, make_prices):
    rng = random.Random(3)
    told = [("X", jan(1) + timedelta(rng.randrange(60)), float(rng.randrange(100)), jan(1) + timedelta(rng.randrange(80))) for _ in range(60)]
    days = [jan(1) + timedelta(n) for n in range(0, 100, 3)]
    rows = as_dicts(asof.join_asof(make_prices([("A", d, 1.0) for d in days]), spark.createDataFrame(told, VINTAGES), SERIES, True), "date")
    for row in rows:
        known = [(d, p, v) for _, d, v, p in told if max(d, p) <= row["date"]]
        assert row["x"] == (max(known)[2] if known else None)


def test_published_at_once_is_the_plain_rule(spark, make_prices):
    rows = [(s, jan(1) + timedelta(n), float(n * 7 % 11)) for s in "XY" for n in range(0, 40, 3)]
    plain = spark.createDataFrame(rows, schemas.OBSERVATIONS)
    prices = make_prices([("A", jan(1) + timedelta(n), 1.0) for n in range(50)])
    at_once = spark.createDataFrame([(*r, r[1]) for r in rows], VINTAGES)
    assert as_dicts(asof.join_asof(prices, at_once, SERIES, True), "date") == as_dicts(asof.join_asof(prices, plain, SERIES), "date")
