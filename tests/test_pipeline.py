"""Landed documents through silver and gold, in batch and incrementally."""

import json
import os
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import as_dicts, jan, rows_of
from tickerloom import schemas
from tickerloom.functions import guarded
from tickerloom.plans import analytics, gold, pipeline, quality, views
from tickerloom.session import shared_folder
from tickerloom.settings import DEFAULT_SERIES, DEFAULT_SYMBOLS, Universe, listed
from tickerloom.sources import bronze, tables
from tickerloom.streaming.landing import follow_prices

MACRO = list(DEFAULT_SERIES.values())


def document(symbol, closes, **override):
    days = [{"datetime": str(jan(1) + timedelta(n)), "open": c, "high": c, "low": c, "close": c,
             "volume": "100", **override} for n, c in enumerate(closes)]
    return {"meta": {"symbol": symbol, "interval": "1day"}, "values": days, "status": "ok"}


@pytest.fixture
def landed(tmp_path):
    prices, macro = tmp_path / "prices", tmp_path / "macro"
    prices.mkdir(), macro.mkdir()

    def land(name, content, pretty=False):
        text = content if isinstance(content, str) else json.dumps(content, indent=2 if pretty else None)
        (prices / f"{name}.json").write_text(text)

    land("aapl", document("AAPL", ["1.5", "2.5", "2.0"]))
    land("msft", document("MSFT", ["7", "8"]), pretty=True)
    land("bad", {"code": 400, "message": "symbol not found", "status": "error"})
    land("cut", '{"meta": {"symbol": "GOOGL"')
    land("empty", {"meta": {"symbol": "XLK"}})
    (macro / "CPIAUCSL.json").write_text(json.dumps({"observations": [
        {"date": "2023-12-01", "value": "300.5"}, {"date": "2024-01-02", "value": "."},
        {"date": "2024-01-03", "value": "301"}]}, indent=2))
    (macro / "OTHER.json").write_text(json.dumps({"observations": [
        {"date": "2024-01-01", "value": "1"}]}))
    return tmp_path, land


def test_documents_are_read_typed_and_rejected(spark, landed):
    folder, _ = landed
    good, rejected = bronze.price_documents(spark, str(folder / "prices"))
    rows = as_dicts(bronze.prices(good), "symbol", "date")
    assert [(r["symbol"], r["date"].day, r["close"], r["volume"]) for r in rows] == [
        ("AAPL", 1, 1.5, 100), ("AAPL", 2, 2.5, 100), ("AAPL", 3, 2.0, 100),
        ("MSFT", 1, 7.0, 100), ("MSFT", 2, 8.0, 100)]
    assert bronze.prices(good).schema == schemas.PRICES
    assert sorted((r["reason"], r["code"], r["message"]) for r in rejected.collect()
                  if r["reason"] == "error answer") == [("error answer", "400", "symbol not found")]
    assert sorted(r["reason"] for r in rejected.collect()) == ["error answer", "no data", "unreadable"]
    assert bronze.prices(good, ["MSFT"]).count() == 2


def test_unreadable_text_becomes_null(spark):
    df = spark.createDataFrame(
        [("abc",), ("",), ("5.0",), ("5",), ("NaN",), ("Infinity",), (None,)], "t string")
    rows = df.select(guarded.number(F.col("t")), guarded.whole_number(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [
        (None, None), (None, None), (5.0, 5), (5.0, 5), (None, None), (None, None), (None, None)]
    dates = df.select(guarded.day(F.lit("2024-01-05")), guarded.day(F.lit("5 Jan"))).first()
    assert tuple(dates) == (jan(5), None)


def test_macro_series_is_named_by_its_file(spark, landed):
    folder, _ = landed
    documents = bronze.macro_documents(spark, str(folder / "macro"))
    assert rows_of(bronze.observations(documents, list(DEFAULT_SERIES))) == rows_of(
        spark.createDataFrame([("CPIAUCSL", date(2023, 12, 1), 300.5), ("CPIAUCSL", jan(3), 301.0)],
                              schemas.OBSERVATIONS))
    assert bronze.observations(documents).count() == 3


def test_latest_landing_wins(spark, landed):
    folder, land = landed
    land("aapl-again", document("AAPL", ["9"]))
    good = bronze.price_documents(spark, str(folder / "prices")).good
    order = F.when(F.col("file_path").contains("again"), 2).otherwise(1)
    rows = bronze.prices(bronze.latest(good, F.lower("symbol"), order))
    assert [r["close"] for r in rows.filter("symbol = 'AAPL'").collect()] == [9.0]
    assert rows.filter("symbol = 'MSFT'").count() == 2


def test_lines_layout(spark, tmp_path):
    lines = [json.dumps(document(s, ["1", "2"])) for s in ("AAPL", "MSFT")]
    (tmp_path / "all.json").write_text("\n".join([*lines, '{"status": "error"}']))
    good, rejected = bronze.price_documents(spark, str(tmp_path), lines=True)
    assert bronze.prices(good).count() == 4 and rejected.count() == 1


def test_jobs_end_to_end(spark, landed):
    folder, land = landed
    paths = [str(folder / name) for name in ("silver", "features", "summary")]
    universe = Universe(("AAPL", "MSFT"))

    def run():
        report = pipeline.run_silver(
            spark, str(folder / "prices"), str(folder / "macro"), paths[0], universe)
        report += pipeline.run_gold(spark, *paths, universe)
        return report, tables.scan(spark, paths[0], schemas.silver(MACRO))

    report, silver = run()
    assert "rejected_documents(unreadable): 1" in report
    assert sum(line.endswith(": OK") for line in report) == 8
    rows = as_dicts(silver, "symbol", "date")
    assert [(r["symbol"], r["cpi"], r["fedFundsRate"]) for r in rows] == [
        ("AAPL", 300.5, None), ("AAPL", 300.5, None), ("AAPL", 301.0, None),
        ("MSFT", 300.5, None), ("MSFT", 300.5, None)]

    land("aapl", document("AAPL", ["1.5", "5.0", "2.0", "4.0"]))   # a correction and a new day
    (folder / "prices" / "msft.json").unlink()                     # dropped, but stays in the tables
    run()
    features, summary = pipeline.gold_tables(spark, paths[1], paths[2], universe)
    assert features.count() == 6 and features.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.gold(MACRO).fields]
    assert [(r["symbol"], r["last_close"], r["as_of_date"].day) for r in as_dicts(summary, "symbol")] \
        == [("AAPL", 4.0, 4), ("MSFT", 8.0, 2)]

    silver = tables.scan(spark, paths[0], schemas.silver(MACRO))
    views.register_views(spark, silver, features, summary, as_of=jan(4))
    for name, columns in {
        "silver_price_with_macro": 10, "gold_daily_features": 29, "gold_symbol_summary": 13,
        "gold_daily_recent": 16, "gold_sector_comparison": 19, "gold_leaderboard": 13,
    }.items():
        df = spark.sql(f"SELECT * FROM {name}")
        assert len(df.columns) == columns and df.count() > 0


def test_new_documents_reach_silver_incrementally(spark, landed):
    folder, land = landed
    silver, universe = str(folder / "silver"), Universe(None)

    def follow():
        observed = bronze.observations(bronze.macro_documents(spark, str(folder / "macro")))
        follow_prices(spark, str(folder / "prices"), observed, silver,
                      str(folder / "progress"), universe).awaitTermination()
        return as_dicts(tables.scan(spark, silver, schemas.silver(MACRO)), "symbol", "date")

    assert len(follow()) == 5
    land("aapl-2", document("AAPL", ["1.5", "5.0", "2.0", "4.0"]))
    rows = follow()
    assert [(r["symbol"], r["close"], r["cpi"]) for r in rows] == [
        ("AAPL", 1.5, 300.5), ("AAPL", 5.0, 300.5), ("AAPL", 2.0, 301.0), ("AAPL", 4.0, 301.0),
        ("MSFT", 7.0, 300.5), ("MSFT", 8.0, 300.5)]
    assert follow() == rows


def test_universe_from_text():
    assert listed(" AAPL, ,MSFT,,", DEFAULT_SYMBOLS) == ("AAPL", "MSFT")
    assert listed("  ", DEFAULT_SYMBOLS) == listed(None, DEFAULT_SYMBOLS) == DEFAULT_SYMBOLS
    universe = Universe.from_text("spy", "DGS10, GDP")
    assert universe.symbols == ("spy",) and universe.series == {"DGS10": "treasury10y", "GDP": "GDP"}
    assert universe.macro_columns == [*MACRO, "GDP"]


def day_values(*days, volume="100"):
    return [{"datetime": d, "open": c, "high": c, "low": c, "close": c, "volume": volume} for d, c in days]


def landings(folder):
    """One symbol in several files: two years apart, then a correction of one day; MSFT once."""
    files = [
        ("a", {"meta": {"symbol": "AAPL"}, "values": day_values(("2023-01-03", "1"), ("2023-01-04", "2"))}),
        ("b", {"meta": {"symbol": "AAPL"}, "values": day_values(("2024-01-03", "3"), ("2024-01-04", "4"))}),
        ("c", {"meta": {"symbol": "MSFT"}, "values": day_values(("2024-01-03", "7"))}),
        ("0", {"meta": {"symbol": "AAPL"}, "values": day_values(("2023-01-04", "20"), ("2024-01-05", "5"))}),
    ]
    folder.mkdir()
    for n, (name, content) in enumerate(files):
        (folder / f"{name}.json").write_text(json.dumps(content))
        os.utime(folder / f"{name}.json", (1_700_000_000 + 60 * n,) * 2)
    return [("AAPL", "2023-01-03", 1.0), ("AAPL", "2023-01-04", 20.0), ("AAPL", "2024-01-03", 3.0),
            ("AAPL", "2024-01-04", 4.0), ("AAPL", "2024-01-05", 5.0), ("MSFT", "2024-01-03", 7.0)]


def contents(spark, path):
    rows = tables.scan(spark, path, schemas.silver(MACRO)).collect()
    return sorted((r.symbol, str(r.date), r.close) for r in rows)


@pytest.mark.parametrize("lines", [False, True])
def test_newest_landing_counts_day_by_day(spark, landed, lines):
    folder, _ = landed
    expected = landings(folder / "again")
    observed = bronze.observations(bronze.macro_documents(spark, str(folder / "macro")))
    pipeline.run_silver(spark, str(folder / "again"), str(folder / "macro"), str(folder / "job"), Universe(), lines=lines)
    assert contents(spark, str(folder / "job")) == expected
    for files in (1, 2, 1000):
        path = str(folder / f"stream{files}")
        follow_prices(spark, str(folder / "again"), observed, path, f"{path}-progress", Universe(), lines=lines,
                      files_per_batch=files).awaitTermination()
        assert contents(spark, path) == expected


def test_rows_repeated_in_one_document_raise(spark, landed):
    folder, land = landed
    land("twice", {"meta": {"symbol": "AMD"}, "values": day_values(("2024-01-03", "3"), ("2024-01-03", "4"))})
    with pytest.raises(tables.DuplicateKeyError, match="AMD"):
        pipeline.run_silver(spark, str(folder / "prices"), str(folder / "macro"), str(folder / "silver"), Universe())
    assert not tables.table_exists(spark, str(folder / "silver"))


def test_rejected_documents_of_both_kinds_are_counted_and_kept(spark, landed):
    folder, _ = landed
    (folder / "macro" / "DGS10.json").write_text('{"observations": [{"date": "2024-')
    (folder / "macro" / "FEDFUNDS.json").write_text('{"error_code": 400}')
    report = pipeline.run_silver(spark, str(folder / "prices"), str(folder / "macro"), str(folder / "silver"), Universe())
    assert [x for x in report if x.startswith("rejected")] == [
        "rejected_documents(error answer): 1", "rejected_documents(no data): 1", "rejected_documents(unreadable): 1",
        "rejected_macro_documents(no data): 1", "rejected_macro_documents(unreadable): 1"]
    observed = bronze.observations(bronze.macro_documents(spark, str(folder / "macro")))
    follow_prices(spark, str(folder / "prices"), observed, str(folder / "s"), str(folder / "progress")).awaitTermination()
    kept = spark.read.parquet(str(folder / "s_rejected")).collect()
    assert sorted(r.reason for r in kept) == ["error answer", "no data", "unreadable"]


def test_jobs_leave_no_copies(spark, landed):
    folder, land = landed
    staged = f"{shared_folder(spark)}/tickerloom/{spark.sparkContext.applicationId}".removeprefix("file:")

    def copies():
        return set(os.listdir(staged)) if os.path.isdir(staged) else set()

    before, paths = copies(), [str(folder / name) for name in ("silver", "features", "summary")]
    pipeline.run_silver(spark, str(folder / "prices"), str(folder / "macro"), paths[0], Universe())
    pipeline.run_gold(spark, *paths)
    observed = bronze.observations(bronze.macro_documents(spark, str(folder / "macro")))
    follow_prices(spark, str(folder / "prices"), observed, str(folder / "s"), str(folder / "progress")).awaitTermination()
    land("negative", document("AAPL", ["-1"]))
    os.utime(folder / "prices" / "negative.json", (2_000_000_000,) * 2)
    with pytest.raises(quality.QualityError):
        pipeline.run_silver(spark, str(folder / "prices"), str(folder / "macro"), paths[0], Universe(), strict=True)
    assert copies() == before


def test_gold_from_changed_keys_equals_a_full_run(spark, make_silver, tmp_path):
    rng = random.Random(1)

    def series(symbol, start, days, step=1):
        return [(symbol, start + timedelta(step * n), float(rng.randrange(50, 150))) for n in range(days)]

    rows = [*series("LONG", date(2020, 1, 1), 1200), *series("SPARSE", date(2015, 1, 1), 400, 9),
            *series("YOUNG", date(2024, 3, 1), 20), *series("SAME", date(2021, 1, 1), 900), *series("NEW", date(2024, 4, 1), 5)]
    corrected = {("LONG", date(2022, 6, 1)), ("SPARSE", date(2015, 1, 1) + timedelta(9 * 364))}
    old = [(s, d, c + 1 if (s, d) in corrected else c)
           for s, d, c in rows if s != "NEW" and (s != "YOUNG" or d < date(2024, 3, 15))]
    assert corrected <= {(s, d) for s, d, _ in old}
    paths = [str(tmp_path / name) for name in ("silver", "features", "summary")]
    tables.upsert(make_silver(old), paths[0])
    pipeline.run_gold(spark, *paths)

    def files():
        return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "features").rglob("*.parquet")}

    before, batch = files(), make_silver(rows)
    tables.write_snapshot(tables.changed_since(batch, paths[0]), str(tmp_path / "changed"))
    tables.upsert(batch, paths[0])
    pipeline.run_gold(spark, *paths, changed=spark.read.parquet(str(tmp_path / "changed")))
    got, summary = pipeline.gold_tables(spark, paths[1], paths[2])
    assert rows_of(got) == rows_of(gold.daily_features(make_silver(rows)).select(*got.columns))
    assert rows_of(summary) == rows_of(gold.symbol_summary(gold.daily_features(make_silver(rows))))
    kept = {name for name, at in files().items() if before.get(name) == at}
    assert {re.search(r"year=(\d+)", n)[1] for n in kept} >= {"2015", "2016", "2017", "2018", "2019", "2020", "2021"}
    assert pipeline.run_gold(spark, *paths, changed=tables.changed_since(batch, paths[0])) == []


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S)


def test_views_and_benchmarks_read_their_directories_only(spark, make_silver, tmp_path):
    rows = [(s, date(y, 5, d), float(d)) for s in ("AAPL", "SPY", "XLK") for y in range(2018, 2025) for d in (1, 2, 3)]
    schema = schemas.gold(MACRO)
    tables.upsert(gold.daily_features(make_silver(rows)), str(tmp_path / "features"))
    table = tables.Table(spark, str(tmp_path / "features"), schema)
    recent = views.daily_recent(table, date(2024, 6, 1))
    assert recent.count() == 3 * 6 and all("year" in f for f in partition_filters(recent))
    compared = partition_filters(views.sector_comparison(table, as_of=date(2024, 6, 1)))
    assert len(compared) == 2 and all("year" in f for f in compared) and sum("bucket" in f for f in compared) == 1
    assert sum("bucket" in f for f in partition_filters(analytics.capm_beta(table))) == 1
    plain = gold.daily_features(make_silver(rows))
    for build in (lambda x: views.sector_comparison(x, as_of=date(2024, 6, 1)), analytics.capm_beta, analytics.tail_risk):
        near = [sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in build(x).collect()) for x in (table, plain)]
        assert near[0] == near[1]
