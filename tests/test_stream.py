"""The stream: checks per micro-batch, rows set aside, features behind it."""

import json
from datetime import date

import pytest

from conftest import jan
from test_ledger import MACRO, Landing
from tickerloom.sources import bronze
from tickerloom.streaming import landing as stream


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def follow(landing, **options):
    observed = bronze.observations(bronze.macro_documents(landing.spark, str(landing.root / "macro")))
    settings = {"ledger_path": landing.book, "gold_paths": tuple(landing.paths[1:]), **options}
    stream.follow_prices(landing.spark, str(landing.root / "prices"), observed, landing.paths[0], str(landing.root / "progress"),
                         landing.universe, **settings).awaitTermination()


def test_bad_rows_are_set_aside_and_the_stream_goes_on(landing):
    landing.land("a", "A", [1, 2, 3])
    twice = [{"datetime": d, "open": c, "high": c, "low": c, "close": c, "volume": v}
             for d, c, v in (("2024-01-03", "3", "1"), ("2024-01-03", "4", "1"), ("2024-01-04", "-5", "-1"), ("2024-01-05", "6", "1"))]
    (landing.root / "prices" / "poison.json").write_text(json.dumps({"meta": {"symbol": "B"}, "values": twice}))
    follow(landing)
    assert set(landing.rows()) == {("A", jan(d)) for d in (1, 2, 3)} | {("B", jan(5))}
    bad = landing.spark.read.parquet(f"{landing.paths[0]}_set_aside").collect()
    assert sorted((r.date.day, r.close, sorted(r.failed_checks)) for r in bad) == [
        (3, 3.0, ["no_duplicates_in(symbol,date)"]), (3, 4.0, ["no_duplicates_in(symbol,date)"]),
        (4, -5.0, ["non_negative_volume", "positive_prices"])]
    report = landing.spark.read.parquet(f"{landing.paths[0]}_quality").collect()
    assert {r.check: r.violating_rows for r in report if not r.passed} == {
        "no_duplicates_in(symbol,date)": 1, "non_negative_volume": 1, "positive_prices": 1}
    landing.land("b", "B", [7], jan(3))   # two years older than the file above by its time stamp
    follow(landing)
    assert landing.rows()["B", jan(3)][0] == 7
    landing.check()


def test_features_follow_whatever_dies(landing, monkeypatch):
    landing.land("a", "A", range(1, 9))
    follow(landing)
    landing.check()
    landing.land("a2", "A", [50], jan(4))
    with monkeypatch.context() as broken:
        broken.setattr(stream, "run_gold", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            follow(landing)
    follow(landing)
    assert landing.rows()["A", jan(4)][0] == 50
    landing.check()
    landing.observe({"2023-01-01": "300", "2024-01-06": "310"})    # revised, and no new document
    follow(landing)
    assert landing.rows()["A", jan(6)] == (6, 310) and landing.rows()["A", jan(5)] == (5, 300)
    landing.check()


def test_gold_needs_a_ledger(landing):
    with pytest.raises(ValueError, match="ledger"):
        follow(landing, ledger_path=None)


def test_rows_of_several_micro_batches(landing):
    for n in range(3):
        landing.land(f"f{n}", "A", [n + 1], date(2024, 1, 1 + n))
    follow(landing, files_per_batch=1)
    assert [landing.rows()["A", jan(1 + n)][0] for n in range(3)] == [1, 2, 3] and len(MACRO) == 3
    landing.check()
