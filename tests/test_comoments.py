"""Kept correlations: the same as from all history, and only the spans of changed days are computed."""

import random
from datetime import date, timedelta

import pytest

from test_ledger import MACRO, Landing
from tickerloom import schemas
from tickerloom.operators.correlation import pairwise_correlation
from tickerloom.plans import comoments
from tickerloom.sources import tables


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def near(df):
    return sorted((r.symbol_a, r.symbol_b, r.correlation and round(r.correlation, 9)) for r in df.collect())


def test_refreshed_sums_equal_a_full_run(spark, landing):
    rng = random.Random(4)
    start = date(2018, 1, 1)
    for symbol in "ABC":
        landing.land(symbol, symbol, [rng.randrange(50, 150) for _ in range(1500)], start)
    features = tables.Table(spark, landing.paths[1], schemas.gold(MACRO))
    sums = str(landing.root / "sums")

    def files():
        return {str(p.relative_to(landing.root)): p.stat().st_mtime_ns for p in (landing.root / "sums").rglob("*.parquet")}

    def check():
        whole = pairwise_correlation(features.rows().select("symbol", "date", "return_1d"), "return_1d")
        assert near(comoments.correlation(spark, sums)) == near(whole)

    landing.silver()
    assert comoments.follow(features, sums, landing.book) is None      # gold goes first
    landing.gold()
    assert comoments.follow(features, sums, landing.book) == start
    check()
    before = files()
    landing.land("B2", "B", [rng.randrange(50, 150) for _ in range(40)], start + timedelta(1490))
    landing.silver()
    assert comoments.follow(features, sums, landing.book) is None
    landing.gold()
    since = comoments.follow(features, sums, landing.book)
    assert since is not None and since >= start + timedelta(1490)
    check()
    kept = {name for name, at in files().items() if before.get(name) == at}
    assert kept == {name for name in before if f"span={(since - date(1970, 1, 1)).days // 512}" not in name} and kept
    assert comoments.follow(features, sums, landing.book) is None
    landing.land("D", "D", [rng.randrange(50, 150) for _ in range(30)], start + timedelta(700))   # a symbol of the past
    landing.silver()
    landing.gold()
    comoments.follow(features, sums, landing.book)
    check()


def test_spans_begin_where_their_sums_do():
    for day in (date(1970, 1, 1), date(1971, 5, 27), date(1971, 5, 28), date(1969, 12, 31), date(2024, 2, 29)):
        first = comoments.first_day(day)
        assert (first - date(1970, 1, 1)).days % 512 == 0 and first <= day < first + timedelta(512)
