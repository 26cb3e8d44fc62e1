"""First write, upsert, layouts and snapshot swap."""

import pytest
from pyspark.sql import functions as F

from conftest import jan, rows_of
from tickerloom import schemas
from tickerloom.session import shared_folder, stage
from tickerloom.sources import tables
from tickerloom.sources.tables import Layout

def test_intermediate_tables_go_to_the_named_folder(spark, make_prices):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    staged = stage(make_prices([("A", jan(1), 1.0)]), "prices")
    assert staged.count() == 1
    assert all(f"{shared_folder(spark)}/tickerloom/" in file for file in staged.inputFiles())


LAYOUTS = [Layout(), Layout(buckets=3), Layout(buckets=3, yearly=True), Layout(yearly=True)]


def read(spark, path, layout):
    return tables.scan(spark, path, schemas.PRICES, layout)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_upsert_updates_inserts_and_keeps(spark, make_prices, tmp_path, layout):
    path = str(tmp_path / "prices")
    first = [("A", jan(1), 1.0), ("A", jan(2), 2.0), ("Gone/1", jan(1), 3.0), ("007", jan(1), 4.0)]
    batch = [("A", jan(2), 20.0), ("A", jan(3), 30.0), ("New", jan(1), 5.0), (None, jan(4), 6.0)]
    assert not tables.table_exists(spark, path)
    tables.upsert(make_prices(first), path, layout)
    assert rows_of(read(spark, path, layout)) == rows_of(make_prices(first))
    for _ in range(2):   # the second time changes nothing
        tables.upsert(make_prices(batch), path, layout)
        expected = [first[0], first[2], first[3], *batch]
        assert rows_of(read(spark, path, layout)) == rows_of(make_prices(expected))


def test_repeated_source_key_raises_and_leaves_the_table(spark, make_prices, tmp_path):
    path = str(tmp_path / "prices")
    twice = make_prices([("A", jan(1), 1.0), ("A", jan(1), 2.0)])
    with pytest.raises(tables.DuplicateKeyError, match="'A'"):
        tables.upsert(twice, path)
    assert not tables.table_exists(spark, path)
    tables.upsert(make_prices([("A", jan(1), 7.0)]), path)
    with pytest.raises(tables.DuplicateKeyError):
        tables.upsert(twice, path)
    assert [r["close"] for r in read(spark, path, tables.DAILY).collect()] == [7.0]


def test_untouched_partitions_keep_their_files(spark, make_prices, tmp_path):
    path = str(tmp_path / "prices")
    by_symbol = tables.BY_SYMBOL
    tables.upsert(make_prices([("A", jan(1), 1.0), ("B", jan(1), 1.0)]), path, by_symbol)

    def files(symbol):
        return {p.name for p in (tmp_path / "prices" / f"symbol={symbol}").glob("*.parquet")}

    a, b = files("A"), files("B")
    tables.upsert(make_prices([("A", jan(2), 1.0)]), path, by_symbol)
    assert files("B") == b and files("A") != a


def test_many_partitions_fall_back_to_a_semi_join(spark, make_prices, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PRUNE_LIMIT", 2)
    path = str(tmp_path / "prices")
    first = [(f"S{n}", jan(1), float(n)) for n in range(6)]
    tables.upsert(make_prices(first), path)
    batch = [(f"S{n}", jan(2), 1.0) for n in range(4)]
    tables.upsert(make_prices(batch), path)
    assert rows_of(read(spark, path, tables.DAILY)) == rows_of(make_prices(first + batch))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_naming_symbols_prunes_directories(spark, make_prices, tmp_path, layout):
    path = str(tmp_path / "prices")
    tables.upsert(make_prices([(f"S{n}", jan(1), 1.0) for n in range(9)]), path, layout)
    df = tables.scan(spark, path, schemas.PRICES, layout, symbols=["S1", "S4"])
    assert sorted(r["symbol"] for r in df.collect()) == ["S1", "S4"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan


def test_foreign_data_is_not_overwritten(spark, make_prices, tmp_path):
    target = tmp_path / "prices"
    target.mkdir()
    (target / "notes.txt").write_text("mine")
    with pytest.raises(ValueError, match="no success marker"):
        tables.upsert(make_prices([("A", jan(1), 1.0)]), str(target))


def test_snapshot_upsert(spark, tmp_path):
    path = str(tmp_path / "summary")

    def snapshot(rows):
        return spark.createDataFrame(rows, "symbol string, last_close double")

    tables.upsert_snapshot(snapshot([("A", 1.0), ("Gone", 2.0)]), path)
    for _ in range(2):
        tables.upsert_snapshot(snapshot([("A", 5.0), ("New", 6.0)]), path)
        assert rows_of(spark.read.parquet(path)) == rows_of(
            snapshot([("A", 5.0), ("Gone", 2.0), ("New", 6.0)]))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["summary"]


def test_interrupted_snapshot_swap_recovers(spark, tmp_path):
    path = str(tmp_path / "summary")
    df = spark.createDataFrame([("A", 1.0)], "symbol string, last_close double")
    tables.upsert_snapshot(df, path)
    (tmp_path / "summary").rename(tmp_path / "summary__previous")
    tables.upsert_snapshot(df.withColumn("symbol", F.lit("B")), path)
    assert sorted(r["symbol"] for r in spark.read.parquet(path).collect()) == ["A", "B"]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_batch_brings_all_columns_with_their_types(spark, make_prices, tmp_path, layout):
    path = str(tmp_path / "prices")
    rate = make_prices([("A", jan(1), 1.0), ("A", jan(2), 2.0)]).withColumn("rate", F.lit(5.0))
    tables.upsert(rate, path, layout)
    batch = make_prices([("A", jan(2), 3.0)])
    for wrong, told in (
        (batch, "rate is missing"),
        (batch.withColumn("rate", F.lit("5")), "rate is string, not double"),
        (batch.withColumns({"rate": F.lit(6.0), "more": F.lit(1)}), "more is new"),
    ):
        with pytest.raises(tables.SchemaChangeError, match=told):
            tables.upsert(wrong, path, layout)
    tables.upsert(batch.withColumns({"rate": F.lit(6.0), "more": F.lit(1)}), path, layout, add_columns=True)
    wide = tables.scan(spark, path, tables.stored_schema(spark, path), layout)
    assert sorted((r.date.day, r.rate, r.more) for r in wide.collect()) == [(1, 5.0, None), (2, 6.0, 1)]
    with pytest.raises(tables.SchemaChangeError, match="more is missing"):
        tables.upsert(rate, path, layout)


def test_a_snapshot_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "summary")
    full = spark.createDataFrame([("A", 1.0, 2.0), ("B", 1.0, 2.0)], "symbol string, last_close double, cpi double")
    tables.upsert_snapshot(full, path)
    for wrong in (full.drop("cpi"), full.withColumn("cpi", F.lit(1)), full.withColumn("new", F.lit(1))):
        with pytest.raises(tables.SchemaChangeError):
            tables.upsert_snapshot(wrong, path)
    tables.upsert_snapshot(full.filter("symbol = 'A'").withColumn("new", F.lit(1)), path, add_columns=True)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("A", 1.0, 2.0, 1), ("B", 1.0, 2.0, None)]


def test_a_first_write_that_died_is_run_again(spark, make_prices, tmp_path, monkeypatch):
    path = str(tmp_path / "prices")
    batch = make_prices([("A", jan(1), 1.0)])

    def dies(df, new, *rest):
        df.write.parquet(f"{new}/year=2024")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_partitioned", dies)
        with pytest.raises(RuntimeError, match="lost"):
            tables.upsert(batch, path)
    assert not tables.table_exists(spark, path)
    tables.upsert(batch, path)
    assert rows_of(read(spark, path, tables.DAILY)) == rows_of(batch)


def test_days_prune_directories(spark, make_prices, tmp_path):
    from datetime import date

    path = str(tmp_path / "prices")
    tables.upsert(make_prices([("A", date(y, 5, 1), 1.0) for y in range(2015, 2025)]), path)
    df = tables.scan(spark, path, schemas.PRICES, since=date(2022, 6, 1))
    assert sorted(r["date"].year for r in df.collect()) == [2023, 2024]
    assert "PartitionFilters: [isnotnull(year" in df._jdf.queryExecution().executedPlan().toString()


def test_changed_keys(spark, make_prices, tmp_path):
    path = str(tmp_path / "prices")
    rows = [("A", jan(1), 1.0), ("A", jan(2), 2.0), ("B", jan(1), 1.0), (None, jan(1), 1.0)]
    assert tables.changed_since(make_prices(rows), path).count() == 4
    tables.upsert(make_prices(rows), path)
    batch = make_prices([*rows[:1], ("A", jan(2), 5.0), ("C", jan(3), 1.0), rows[3]])
    assert sorted((r.symbol, r.date.day) for r in tables.changed_since(batch, path).collect()) == [("A", 2), ("C", 3)]
