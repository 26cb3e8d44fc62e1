"""Warm-up, zero denominators and long frames of the daily features."""

import math
import random
import statistics
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import as_dicts, jan
from tickerloom import schemas
from tickerloom.plans import gold, views


def features(df):
    return as_dicts(gold.daily_features(df), "symbol", "date")


def test_rsi_and_volatility_warm_up(make_silver):
    closes = [10.0, 11.0, 10.5, 10.5, 12.0]
    rows = features(make_silver(
        [("A", jan(d), c) for d, c in enumerate(closes, 1)] + [("B", jan(1), 5.0)]
    ))
    a, b = rows[:5], rows[5]
    assert [r["rsi_14"] for r in a] == pytest.approx([100, 100, 66.6667, 66.6667, 83.3333], abs=1e-4)
    assert a[0]["return_1d"] is None
    assert [r["return_1d"] for r in a[1:]] == pytest.approx([0.1, -0.045455, 0, 0.142857], abs=1e-6)
    assert a[0]["vol_21d"] is None and a[1]["vol_21d"] is None
    assert [r["vol_21d"] for r in a[2:]] == pytest.approx([0.102852, 0.074412, 0.087049], abs=1e-6)
    assert a[2]["vol_ann_21d"] == pytest.approx(a[2]["vol_21d"] * math.sqrt(252))
    assert (b["rsi_14"], b["return_1d"], b["vol_21d"], b["sma_200"]) == (100, None, None, 5.0)
    assert [r["sma_200"] for r in a] == pytest.approx(
        [statistics.mean(closes[:n]) for n in range(1, 6)]
    )


def test_columns_and_order(make_silver):
    df = gold.daily_features(make_silver([("A", jan(1), 1.0)]))
    assert df.schema.simpleString() == schemas.gold(["cpi", "fedFundsRate", "treasury10y"]).simpleString()
    assert len(df.columns) == 29


def test_long_frames_equal_direct_windows(make_silver):
    """The 50-, 200- and 252-row frames against plain Python, with gaps in the values."""
    rng = random.Random(5)
    rows = []
    for symbol, days in (("A", 600), ("B", 251), ("C", 64)):
        for n in range(days):
            close = None if rng.random() < 0.1 else rng.randrange(1, 1000) / 7
            high = None if rng.random() < 0.1 else rng.randrange(1, 1000) / 3
            volume = None if rng.random() < 0.1 else rng.randrange(1, 1000)
            rows.append((symbol, jan(1) + timedelta(n), close, high, close, close, volume))
    got = features(make_silver(rows))
    for symbol in "ABC":
        mine = [r for r in rows if r[0] == symbol]
        ours = [r for r in got if r["symbol"] == symbol]

        def frame(i, size, at):
            return [r[at] for r in mine[max(0, i - size + 1):i + 1] if r[at] is not None]

        for i, row in enumerate(ours):
            for size in (20, 50, 200):
                known = frame(i, size, 5)
                mean = statistics.fmean(known) if known else None
                assert row[f"sma_{size}"] == (pytest.approx(mean) if known else None)
            highs, close = frame(i, 252, 3), mine[i][5]
            if highs and close is not None:
                assert row["drawdown_252d"] == pytest.approx(close / max(highs) - 1)
            else:
                assert row["drawdown_252d"] is None
            volumes, volume = frame(i, 20, 6), mine[i][6]
            if volumes and volume is not None:
                assert row["volume_rel_20d"] == pytest.approx(volume / statistics.fmean(volumes))


def test_zero_denominators_give_null(make_silver):
    rows = features(make_silver(
        [("A", jan(d), 1.0, 1.0, 1.0, 1.0, 0) for d in range(1, 22)]
        + [("B", jan(1), 0.0), ("B", jan(2), 3.0)]
    ))
    assert all(r["volume_rel_20d"] is None for r in rows if r["symbol"] == "A")
    assert [r["return_1d"] for r in rows if r["symbol"] == "B"] == [None, None]


def test_macro_changes(make_silver):
    df = make_silver([("A", jan(d), 1.0) for d in range(1, 24)]).withColumns({
        "cpi": F.day("date") * 1.0,
        "fedFundsRate": F.when(F.day("date") > 1, F.floor(F.day("date") / 10) * 1.0),
        "treasury10y": F.lit(4.0),
    })
    rows = features(df)
    assert [r["cpi_chg_1m"] for r in rows] == [None] * 21 + [22 / 1 - 1, 23 / 2 - 1]
    assert [r["fed_funds_chg"] for r in rows[:3]] == [None, None, 0]
    assert [r["date"].day for r in rows if r["fed_funds_chg"]] == [10, 20]
    assert [r["treasury10y_chg"] for r in rows] == [None] + [0.0] * 22


def test_one_exchange_and_two_windows(make_silver):
    df = gold.daily_features(make_silver([("A", jan(1), 1.0)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol") == 1 == plan.count("Exchange")
    assert plan.count("Window [") == 2
    assert plan.count("+- Sort [") == 1


def test_snapshot_keeps_latest_row(make_silver):
    df = gold.symbol_summary(gold.daily_features(make_silver(
        [("A", jan(1), 1.0), ("A", jan(3), 2.0), ("B", jan(2), 3.0)]
    )))
    assert [(r["symbol"], r["as_of_date"], r["last_close"]) for r in as_dicts(df, "symbol")] == [
        ("A", jan(3), 2.0), ("B", jan(2), 3.0)
    ]
    assert len(df.columns) == 13


def test_snapshot_drops_older_rows_before_the_shuffle(spark, make_silver, tmp_path):
    path = str(tmp_path / "gold")
    gold.daily_features(make_silver([("A", jan(1), 1.0)])).write.parquet(path)
    plan = gold.symbol_summary(spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    above, below = plan.toString().split("Exchange hashpartitioning(symbol", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_leaderboard_ranks_nulls_last_and_shares_ties(spark):
    schema = (
        "symbol string, as_of_date date, last_close double, return_1m double, return_3m double, "
        "vol_ann_1m double, rsi_14 double, drawdown_252d double, dist_sma_50 double, "
        "dist_sma_200 double, cpi double, fedFundsRate double, treasury10y double"
    )
    rest = [None] * 7
    table = spark.createDataFrame([
        ("XLK", jan(1), 1.0, 0.5, None, None, *rest), ("B", jan(1), 1.0, 0.5, None, 0.2, *rest),
        ("C", jan(1), 1.0, None, None, 0.1, *rest), ("D", jan(1), 1.0, 0.4, None, 0.3, *rest),
    ], schema)
    rows = {r["symbol"]: r for r in views.leaderboard(table).collect()}
    assert {s: r["rank_return_1m"] for s, r in rows.items()} == {"XLK": 1, "B": 1, "D": 3, "C": 4}
    assert {s: r["rank_lowest_vol"] for s, r in rows.items()} == {"C": 1, "B": 2, "D": 3, "XLK": 4}
    assert {s: r["asset_type"] for s, r in rows.items()}["XLK"] == "ETF"
