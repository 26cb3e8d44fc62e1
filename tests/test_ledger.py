"""The ledger between landing, silver and gold: nothing is parsed, rewritten or recomputed twice, or lost."""

import json
import os
from datetime import date, timedelta

import pytest

from conftest import jan, rows_of
from tickerloom import schemas
from tickerloom.operators.asof import revised_days
from tickerloom.plans import gold, pipeline
from tickerloom.settings import DEFAULT_SERIES, Universe
from tickerloom.sources import bronze, tables
from tickerloom.sources.ledger import Ledger

MACRO = list(DEFAULT_SERIES.values())


class Landing:
    """A landing folder whose files are a minute apart, and the two jobs over it."""

    def __init__(self, spark, root, universe=Universe(None)):
        self.spark, self.root, self.universe, self.clock = spark, root, universe, 1_700_000_000
        (root / "prices").mkdir()
        (root / "macro").mkdir()
        self.paths = [str(root / name) for name in ("silver", "features", "summary")]
        self.book = str(root / "ledger")
        self.observe({"2023-01-01": "300"})

    def land(self, name, symbol, closes, start=jan(1), at=None):
        days = [{"datetime": str(start + timedelta(n)), **dict.fromkeys(("open", "high", "low", "close"), str(c)), "volume": "100"}
                for n, c in enumerate(closes)]
        path = self.root / "prices" / f"{name}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps({"meta": {"symbol": symbol}, "values": days}))
        self.clock += 60
        os.utime(path, (at or self.clock,) * 2)

    def observe(self, values, series="CPIAUCSL"):
        points = [{"date": d, "value": v} for d, v in values.items()]
        (self.root / "macro" / f"{series}.json").write_text(json.dumps({"observations": points}))

    def silver(self, **options):
        return pipeline.run_silver(self.spark, str(self.root / "prices"), str(self.root / "macro"), self.paths[0],
                                   self.universe, ledger_path=self.book, **options)

    def gold(self):
        return pipeline.run_gold(self.spark, *self.paths, self.universe, ledger_path=self.book)

    def rows(self):
        found = tables.scan(self.spark, self.paths[0], schemas.silver(MACRO)).collect()
        return {(r.symbol, r.date): (r.close, r.cpi) for r in found}

    def check(self):
        """Gold is what the whole of silver gives."""
        silver = tables.scan(self.spark, self.paths[0], schemas.silver(MACRO))
        got, summary = pipeline.gold_tables(self.spark, self.paths[1], self.paths[2], self.universe)
        whole = gold.daily_features(silver)
        assert rows_of(got) == rows_of(whole.select(*got.columns))
        assert rows_of(summary) == rows_of(gold.symbol_summary(whole))

    def written(self, table="silver"):
        return {str(p.relative_to(self.root)): p.stat().st_mtime_ns for p in (self.root / table).rglob("*.parquet")}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


@pytest.fixture
def parsed(monkeypatch):
    """What each silver run reads: file names, or the folder."""
    runs, usual = [], bronze.raw_price_documents

    def record(reader, path, *args):
        runs.append(sorted(os.path.basename(p) for p in path) if isinstance(path, list) else path)
        return usual(reader, path, *args)

    monkeypatch.setattr(bronze, "raw_price_documents", record)
    return runs


def test_changes_of_several_silver_runs_reach_gold(landing):
    landing.land("a", "A", range(1, 9))
    landing.land("b", "B", range(11, 15))
    landing.silver()
    landing.gold()
    landing.check()
    landing.land("a2", "A", [50], jan(4))
    landing.silver()
    landing.silver()
    landing.land("b2", "B", [60, 61], jan(14))
    landing.silver()
    assert landing.gold() != []
    landing.check()
    assert landing.gold() == []
    landing.silver()
    assert landing.gold() == []
    landing.check()


def test_a_gold_run_that_dies_is_made_up_for(landing, monkeypatch):
    landing.land("a", "A", range(1, 9))
    landing.silver()
    landing.gold()
    for n, dies in enumerate(("upsert", "upsert_snapshot")):
        landing.land(f"a{n}", "A", [70 + n], jan(3))
        landing.silver()
        with monkeypatch.context() as broken:
            broken.setattr(pipeline, dies, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                landing.gold()
        landing.silver()
        assert landing.gold() != []
        landing.check()
        assert landing.gold() == []


@pytest.mark.parametrize("late", [False, True])
def test_a_silver_run_that_dies_is_made_up_for(landing, monkeypatch, parsed, late):
    """Before or after its upsert; gold runs in between."""
    landing.land("a", "A", range(1, 9))
    landing.silver()
    landing.gold()
    landing.land("a2", "A", [50], jan(4))
    usual = tables.upsert

    def upsert(*args, **options):
        if late:
            usual(*args, **options)
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "upsert", upsert)
        with pytest.raises(RuntimeError, match="lost"):
            landing.silver()
    landing.gold()
    landing.check()
    landing.silver()
    assert parsed[-1] == ["a2.json"] and landing.rows()["A", jan(4)][0] == 50
    assert landing.gold() != []
    landing.check()
    assert landing.gold() == []


def test_a_mark_stops_before_an_entry_that_is_not_settled(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "book"))
    keys = spark.createDataFrame([("A", jan(1))], "symbol string, date date")

    def entry():
        new = book.begin()
        new.write("changes", keys)
        return new

    assert book.pending("x", keys.schema).changes is None
    first = entry()
    assert book.pending("x", keys.schema).changes is None    # not prepared: silver is untouched
    first.prepare()
    pending = book.pending("x", keys.schema)
    assert pending.changes.count() == 1 and pending.mark == 0
    first.commit()
    assert book.pending("x", keys.schema).mark == 1
    book.move("x", 1)
    book.move("x", 0)
    assert book.mark_of("x") == 1 and book.mark_of("y") == 0
    second = entry()
    second.prepare()
    third = entry()                                          # the second run died
    assert book.pending("x", keys.schema).mark == 2
    third.prepare()
    pending = book.pending("x", keys.schema)
    assert pending.changes.count() == 2 and pending.mark == 2
    book.begin()
    assert book.pending("x", keys.schema).mark == 3


def test_nothing_new_parses_nothing_and_rewrites_nothing(landing, parsed):
    landing.land("a", "A", range(1, 9), date(2022, 12, 28))
    landing.land("b", "B", range(11, 15))
    landing.silver()
    before = landing.written()
    report = landing.silver()
    assert len(parsed) == 1 and landing.written() == before and all(line.endswith("OK") for line in report)
    landing.land("a2", "A", [9], date(2023, 1, 5))
    landing.silver()
    changed = {name for name, at in landing.written().items() if before.get(name) != at}
    assert parsed[1:] == [["a2.json"]] and len(changed) == 1 and "year=2023" in changed.pop()
    kept = set(before) & set(landing.written())
    assert any("year=2022" in name for name in kept) and any("year=2024" in name for name in kept)


def test_without_a_ledger_an_unchanged_run_rewrites_nothing_either(landing):
    landing.land("a", "A", range(1, 9))
    run = lambda: pipeline.run_silver(landing.spark, str(landing.root / "prices"), str(landing.root / "macro"), landing.paths[0], landing.universe)
    run()
    before = landing.written()
    run()
    assert landing.written() == before


def test_replaced_and_late_files(landing, parsed):
    landing.land("a", "A", [1, 2, 3])
    landing.land("b", "A", [20], jan(2))
    landing.silver()
    landing.land("b", "A", [21], jan(2))                      # replaced
    landing.silver()
    assert parsed[-1] == ["b.json"] and landing.rows()["A", jan(2)][0] == 21
    landing.land("late", "A", [99, 99, 99, 4], at=1_700_000_100)   # landed between a and b, seen only now
    landing.silver()
    assert parsed[-1] == ["b.json", "late.json"]
    assert [landing.rows()["A", jan(d)][0] for d in (1, 2, 3, 4)] == [99, 21, 99, 4]
    whole = Landing.__new__(Landing)
    whole.__dict__.update(landing.__dict__, book=str(landing.root / "other"), paths=[str(landing.root / "again")])
    whole.silver()
    assert whole.rows() == landing.rows()


def test_odd_file_names_and_a_wider_universe(spark, tmp_path, parsed):
    landing = Landing(spark, tmp_path, Universe(("A",)))
    landing.land("a", "A", [1])
    landing.land("b", "B", [2])
    landing.silver()
    assert set(landing.rows()) == {("A", jan(1))}
    landing.land("[x] {1,2}*%20é", "A", [7])
    landing.silver()
    assert len(parsed[-1]) == 1 and landing.rows()["A", jan(1)][0] == 7
    landing.universe = Universe(("A", "B"))
    landing.silver()
    assert len(parsed[-1]) == 3 and landing.rows()["B", jan(1)][0] == 2 and landing.rows()["A", jan(1)][0] == 7


def test_the_list_of_files_is_repeated_now_and_then(landing, parsed, monkeypatch):
    monkeypatch.setattr("tickerloom.sources.ledger.WHOLE_EVERY", 2)
    for n in range(6):
        landing.land(f"f{n}", "A", [n], jan(1 + n))
        landing.silver()
    assert parsed[1:] == [[f"f{n}.json"] for n in range(1, 6)] and len(landing.rows()) == 6
    known, _ = Ledger(landing.spark, landing.book).files()
    assert known.select("file_path").distinct().count() == 6 and known.count() < 12


def test_revised_macro_values_reach_stored_rows(landing, parsed):
    landing.observe({"2022-06-01": "290", "2023-06-01": "300", "2024-01-03": "310"})
    landing.land("a", "A", range(1, 6), date(2022, 12, 30))
    landing.land("b", "A", range(1, 6), date(2023, 12, 30))
    landing.land("c", "A", range(1, 3), date(2021, 12, 30))
    landing.silver()
    landing.gold()
    before = landing.written()
    landing.observe({"2022-06-01": "290", "2023-06-01": "305", "2024-01-03": "310"})   # revised in the middle
    landing.silver()
    rows = landing.rows()
    assert rows["A", date(2023, 1, 1)][1] == 290 and rows["A", date(2023, 12, 31)][1] == 305 and rows["A", jan(2)][1] == 305
    assert rows["A", jan(3)][1] == 310 and rows["A", date(2021, 12, 30)][1] is None and len(parsed) == 1
    kept = {name for name, at in landing.written().items() if before.get(name) == at}
    assert {"year=2021", "year=2022"} == {name.split("/")[2] for name in kept}
    landing.gold()
    landing.check()
    landing.observe({"2022-06-01": "290", "2023-06-01": "305", "2024-01-03": "310", "2024-02-01": "320"})   # later than all rows
    before = landing.written()
    landing.silver()
    assert landing.written() == before
    landing.land("d", "A", [9], date(2024, 2, 5))
    landing.silver()
    landing.observe({"2022-06-01": "290", "2023-06-01": "305", "2024-01-03": "310"})   # withdrawn: the tail changes
    landing.silver()
    assert landing.rows()["A", date(2024, 2, 5)][1] == 310
    landing.gold()
    landing.check()


def test_revised_days(spark):
    series = {"A": "a", "B": "b"}
    rows = lambda *points: spark.createDataFrame([(s, date.fromisoformat(d), v) for s, d, v in points], schemas.OBSERVATIONS)
    old = rows(("A", "2024-01-01", 1.0), ("B", "2024-01-03", 5.0), ("A", "2024-01-05", 2.0))

    def days(new):
        found, last = revised_days(old, new, series)
        return sorted(r.day.day for r in found.collect()), last

    assert days(old) == ([], jan(5))
    assert days(old.union(rows(("A", "2024-01-07", 2.0)))) == ([], jan(7))
    assert days(old.union(rows(("A", "2024-01-07", 3.0)))) == ([7], jan(7))
    assert days(old.filter("series_id = 'A'")) == ([3, 4, 5], jan(5))
    assert days(old.limit(0)) == ([1, 2, 3, 4, 5], jan(5))
    assert revised_days(old.limit(0), old.limit(0), series)[0].count() == 0
