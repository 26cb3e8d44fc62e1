"""Ranking, correlation and the benchmark lookup against brute force."""

import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import as_dicts, jan
from tickerloom.operators.benchmark import benchmark_by_date
from tickerloom.operators.correlation import pairwise_correlation
from tickerloom.operators.rank import Ranking, sliced_rank, with_ranks
from tickerloom.plans import analytics, charts
from tickerloom.settings import Roles


@pytest.mark.parametrize("descending", [True, False])
def test_sliced_rank_equals_rank(spark, descending):
    rng = random.Random(3)
    values = [rng.choice([None, 0.0, 0.0, 0.0, rng.gauss(0, 1)]) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = {r["id"]: r["place"] for r in sliced_rank(df, Ranking("v", "place", descending)).collect()}
    known = [v for v in values if v is not None]
    frame = pd.Series(known).rank(method="min", ascending=not descending)
    place = dict(zip(known, frame.astype(int)))
    assert got == {i: place.get(v, len(known) + 1) for i, v in enumerate(values)}


def test_both_ways_of_ranking_agree(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "id int, v double")
    ranking = [Ranking("v", "up"), Ranking("v", "down", descending=True)]
    small, large = with_ranks(df, ranking), with_ranks(df, ranking, one_task=10)
    assert as_dicts(small, "id") == as_dicts(large, "id")
    assert small.schema["up"].dataType == large.schema["up"].dataType


def _series(symbols, days, seed, gap):
    rng = random.Random(seed)
    start = date(2010, 1, 1)
    rows = []
    for n in range(days):
        common = rng.gauss(0, 0.01)
        for s in range(symbols):
            value = None if rng.random() < gap else common * (s % 3) + rng.gauss(0.001, 0.01)
            if rng.random() > gap:
                rows.append((f"S{s}", start + timedelta(n), value))
    return rows


@pytest.mark.parametrize("blocks,days", [(1, 4096), (3, 4096), (3, 50), (None, 64)])
def test_pairwise_correlation_equals_pandas(spark, blocks, days):
    rows = _series(13, 200, 7, 0.2)
    df = spark.createDataFrame(rows, "symbol string, date date, r double")
    frame = pd.DataFrame(rows, columns=["symbol", "date", "r"])
    expected = frame.pivot(index="date", columns="symbol", values="r").astype(float).corr()
    got = pairwise_correlation(df, "r", blocks, days).collect()
    assert len(got) == 13 * 12 / 2
    for row in got:
        assert row["symbol_a"] < row["symbol_b"]
        assert -1 - 1e-12 <= row["correlation"] <= 1 + 1e-12
        assert row["correlation"] == pytest.approx(
            expected.loc[row["symbol_a"], row["symbol_b"]], abs=1e-12)


@pytest.mark.parametrize("days", [4096, 3])
def test_undefined_correlations_are_null(spark, days):
    constant = [("A", jan(d), 0.1) for d in range(1, 9)]
    moving = [("B", jan(d), 0.01 * d * (-1) ** d) for d in range(1, 9)]
    single = [("C", jan(4), 0.3), ("C", jan(20), 0.4), ("C", jan(21), 0.6)]
    # D varies, but not on the days it shares with B.
    partly = [("D", jan(d), 0.7) for d in range(1, 9)] + [("D", jan(d), 0.1 * d) for d in (20, 21)]
    apart = [("E", jan(25), 0.3), ("E", jan(26), 0.1)]
    df = spark.createDataFrame(constant + moving + single + partly + apart,
                               "symbol string, date date, r double")
    got = {(r["symbol_a"], r["symbol_b"]): r["correlation"]
           for r in pairwise_correlation(df, "r", 2, days).collect()}
    assert got == {
        ("A", "B"): None, ("A", "C"): None, ("A", "D"): None, ("B", "C"): None, ("B", "D"): None,
        ("C", "D"): pytest.approx(np.corrcoef([0.3, 0.4, 0.6], [0.7, 2.0, 2.1])[0, 1]),
    }


def test_correlation_refuses_repeated_days(spark):
    df = spark.createDataFrame([("A", jan(1), 0.1), ("A", jan(1), 0.2)],
                               "symbol string, date date, r double")
    with pytest.raises(Exception, match="one row per symbol and date"):
        pairwise_correlation(df, "r").collect()


def _features(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, return_1d double")


def test_benchmark_refuses_repeated_days(spark):
    df = _features(spark, [("M", jan(1), 0.1), ("M", jan(1), 0.1)])
    with pytest.raises(Exception, match="more than one row"):
        benchmark_by_date(df, "M", {"return_1d": "m"}).collect()


def test_beta_keeps_each_statistics_population(spark):
    market = {1: 0.01, 2: -0.02, 3: 0.03, 4: None, 5: 0.05}
    asset = {1: 0.02, 2: None, 3: 0.05, 4: 0.9, 5: 0.01}
    df = _features(spark, [("SPY", jan(d), v) for d, v in market.items()]
                   + [("A", jan(d), v) for d, v in asset.items()] + [("B", jan(9), 0.1)])
    rows = analytics.capm_beta(df).collect()
    assert [r["symbol"] for r in rows] == ["A"]   # B shares no day with the market
    both = [d for d in market if market[d] is not None and asset[d] is not None]
    x, y = [asset[d] for d in both], [market[d] for d in both]
    known = [v for v in market.values() if v is not None]
    returns = [v for v in asset.values() if v is not None]
    assert rows[0]["beta"] == pytest.approx(np.cov(x, y)[0, 1] / np.var(known, ddof=1))
    assert rows[0]["correlation_to_spy"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert rows[0]["naive_alpha"] == pytest.approx(np.mean(returns) - np.mean(known))


def test_flat_market_gives_null_beta(spark):
    df = _features(spark, [("SPY", jan(d), 0.0) for d in (1, 2, 3)]
                   + [("A", jan(d), 0.1 * d) for d in (1, 2, 3)])
    row = analytics.capm_beta(df).collect()[0]
    assert (row["beta"], row["correlation_to_spy"]) == (None, None)
    assert charts.beta_flagged(df).collect()[0]["above_market"] is False


def test_tail_risk_without_a_bad_day(spark):
    df = _features(spark, [("SPY", jan(1), 0.0), ("SPY", jan(2), -0.05), ("A", jan(1), 0.1),
                           ("B", jan(1), 0.2), ("B", jan(2), -0.3)])
    rows = [tuple(r) for r in analytics.tail_risk(df).collect()]
    assert rows == [("B", -0.3, 1), ("A", None, 0)]


def test_regimes_count_days_without_a_return(spark):
    df = spark.createDataFrame(
        [("A", 0.5, None), ("A", 0.1, 0.2), ("A", 0.0, 0.4), ("A", -1.0, 0.6), ("A", None, 9.0)],
        "symbol string, fed_funds_chg double, return_1d double")
    assert [tuple(r) for r in analytics.rate_regime(df).collect()] == [
        ("A", "easing", 0.6, 1), ("A", "stable", 0.4, 1), ("A", "tightening", 0.2, 2)]
    assert [tuple(r) for r in charts.regime_wide(df).collect()] == [("A", 0.6, 0.4, 0.2)]


def test_benchmark_has_no_alpha_of_its_own(spark, make_silver):
    from tickerloom.plans import gold, views

    features = gold.daily_features(make_silver(
        [(s, jan(d), 1.0 + d * k) for s, k in (("XLK", 1), ("NVDA", 2)) for d in range(1, 6)]))
    rows = as_dicts(views.sector_comparison(features, Roles(), jan(5)), "symbol", "date")
    assert {r["alpha_1d"] for r in rows if r["symbol"] == "XLK"} == {None, 0.0}
    assert {(r["symbol"], r["asset_type"], r["sector"]) for r in rows} == {
        ("XLK", "ETF", "Tech (broad)"), ("NVDA", "STOCK", "Semiconductors")}


def test_recent_keeps_two_years_before_as_of(spark, make_silver):
    from tickerloom.plans import gold, views

    days = [date(2022, 1, 4), date(2022, 1, 5), date(2024, 1, 5)]
    features = gold.daily_features(make_silver([("A", d, 1.0) for d in days]))
    kept = as_dicts(views.daily_recent(features, days[-1]), "date")
    assert [r["date"] for r in kept] == days[1:]
    newest = features.agg(F.max("date")).scalar()
    assert views.daily_recent(features, newest).count() == 2
    assert views.daily_recent(features).count() == 0   # today by default


def test_joins_to_benchmark_and_market_are_broadcast(spark):
    df = _features(spark, [("SPY", jan(1), 0.0), ("A", jan(1), 0.1)])
    plan = analytics.capm_beta(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_each_sector_may_have_its_own_benchmark(spark, make_silver):
    from tickerloom.plans import gold, views

    growth = {"XLK": 1, "SOXX": 3, "NVDA": 2, "AAPL": 5}
    features = gold.daily_features(make_silver(
        [(s, jan(d), 10.0 + d * k) for s, k in growth.items() for d in (1, 2, 3)]))
    roles = Roles(benchmark_of={"Semiconductors": "SOXX"})
    rows = views.beside_benchmark(features, roles, jan(3)).collect()
    returns = {(r["symbol"], r["date"]): r["return_1d"] for r in rows}
    assert len(rows) == 12
    for r in rows:
        benchmark = "SOXX" if r["symbol"] in ("SOXX", "NVDA") else "XLK"
        assert r["sector_return_1d"] == returns[benchmark, r["date"]]


def test_classification_may_be_a_table(spark, make_silver):
    from tickerloom.plans import gold, views

    table = spark.createDataFrame(
        [("A", "ETF", "Energy"), ("A", "ETF", "Energy"), ("B", "STOCK", None)],
        "symbol string, asset_type string, sector string")
    features = gold.daily_features(make_silver([(s, jan(1), 1.0) for s in "ABC"]))
    rows = as_dicts(views.daily_recent(features, jan(1), table), "symbol")
    assert [(r["symbol"], r["asset_type"], r["sector"]) for r in rows] == [
        ("A", "ETF", "Energy"), ("B", "STOCK", "Tech (broad)"), ("C", "STOCK", "Tech (broad)")]
    board = views.leaderboard(gold.symbol_summary(features), table)
    assert {r["symbol"]: r["asset_type"] for r in board.collect()}["A"] == "ETF"


def _correlation(spark, rows, **options):
    df = spark.createDataFrame(rows, "symbol string, date date, r double")
    return {(r["symbol_a"], r["symbol_b"]): r["correlation"]
            for r in pairwise_correlation(df, "r", **options).collect()}


@pytest.mark.parametrize("days", [4096, 16])
def test_correlation_of_small_moves_on_a_large_level(spark, days):
    from datetime import timedelta

    rows = [(s, jan(1) + timedelta(n), 1 + k * n * 1e-7) for s, k in (("A", 1), ("B", 2)) for n in range(50)]
    assert abs(_correlation(spark, rows, days=days)["A", "B"] - 1) < 1e-9
    rows += [("C", d, 5 - v) for s, d, v in rows if s == "A"]
    assert abs(_correlation(spark, rows, days=days)["A", "C"] + 1) < 1e-9


@pytest.mark.parametrize("days", [4096, 16])
def test_correlation_is_not_hurt_by_days_the_pair_does_not_share(spark, days):
    from datetime import timedelta

    rows = [(s, jan(1) + timedelta(n), k * n * 1e-7) for s, k in (("A", 1), ("B", 3)) for n in range(50)]
    rows += [("A", jan(1) + timedelta(60), 1e9), ("FLAT", jan(1) + timedelta(60), 1.0)]
    rows += [("FLAT", jan(1) + timedelta(n), 0.1) for n in range(50)]
    got = _correlation(spark, rows, days=days)
    assert abs(got["A", "B"] - 1) < 1e-9
    assert got["B", "FLAT"] is None and got["A", "FLAT"] is not None


def test_correlation_of_named_symbols_only(spark):
    rows = [(s, jan(d), float(d * k % 7)) for s, k in (("A", 1), ("B", 3), ("C", 5)) for d in range(1, 20)]
    assert _correlation(spark, rows, symbols=["A", "C"]).keys() == {("A", "C")}
    some, every = _correlation(spark, rows, symbols=["A", "C"]), _correlation(spark, rows, days=5)
    assert abs(some["A", "C"] - every["A", "C"]) < 1e-12


def test_bars_take_any_line_number_and_price(spark, tmp_path):
    from datetime import datetime

    from tickerloom import bindings

    rows = [  # order, line, dollars
        (7, 1500, 50.0), (7, 2, 99.0), (7, 1500, -40.0), (8, 1, -99999.99), (8, 9_999_999, 1e11), (6, 3, 4e11), (6, 3, -4e11)]
    lines = [(o, 1, n, 1.0, p, datetime(2024, 1, 1)) for o, n, p in rows]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "A")], "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    (bar,) = bindings.bars(spark, str(tmp_path)).collect()
    structs = sorted((o, n, round(p * 100)) for o, n, p in rows)
    assert (bar.open, bar.close) == (structs[0][2], structs[-1][2])
    assert (bar.high, bar.low) == (max(s[2] for s in structs), min(s[2] for s in structs))
    for o, n, p in ((10**16, 1, 1.0), (1, 10**7, 1.0), (1, 1, 6e11), (-1, 1, 1.0)):
        spark.createDataFrame([(o, 1, n, 1.0, p, datetime(2024, 1, 1))], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp") \
            .write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
        with pytest.raises(Exception, match="out of range|CAST_OVERFLOW|NUMERIC_VALUE_OUT_OF_RANGE"):
            bindings.bars(spark, str(tmp_path)).collect()
