"""Seeded violations are counted exactly and only a strict run fails."""

import pytest

from conftest import jan
from tickerloom.plans import quality


def counts(results):
    return {row["check"].split("(")[0]: row["violating_rows"] for row in results.collect()}


@pytest.fixture
def dirty(make_prices):
    return make_prices([
        ("A", jan(1), 1.0, 2.0, 1.0, 1.0, 5),
        ("A", jan(2), 1.0, 2.0, 1.0, 1.0, 5),
        ("A", jan(2), 1.0, 2.0, 1.0, 1.0, -5),     # negative volume
        ("A", jan(2), 1.0, 2.0, 1.0, None, 5),     # missing close; key three times
        ("B", jan(2), 1.0, 2.0, 3.0, 1.0, 0),      # high below low
        ("B", jan(3), 0.0, 2.0, 1.0, None, None),  # zero open and missing close
        (None, jan(3), 1.0, 2.0, -1.0, 1.0, 5),    # missing symbol, negative low
        (None, jan(3), 1.0, 2.0, 1.0, 1.0, 5),     # missing symbol, repeated
    ])


def test_silver_suite(dirty):
    assert counts(quality.silver_quality(dirty)) == {
        "no_nulls_in": 4, "no_duplicates_in": 2, "positive_prices": 2,
        "high_greater_or_equal_low": 1, "non_negative_volume": 1,
    }


def test_gold_suite_names_and_status(dirty):
    rows = {r["check"]: (r["violating_rows"], r["passed"], r["status"])
            for r in quality.gold_quality(dirty).collect()}
    assert rows == {
        "no_duplicates_in(symbol,date)": (2, False, "FAILED (2 rows)"),
        "no_nulls_in(symbol,date,close)": (4, False, "FAILED (4 rows)"),
        "positive_prices": (2, False, "FAILED (2 rows)"),
    }


def test_clean_and_empty_tables_pass(make_prices):
    clean = make_prices([("A", jan(1), 1.0)])
    for df in (clean, clean.limit(0)):
        results = quality.silver_quality(df)
        assert set(counts(results).values()) == {0}
        assert all(line.endswith(": OK") for line in quality.enforce(results, strict=True))


def test_only_strict_raises(dirty):
    results = quality.silver_quality(dirty)
    assert "positive_prices: FAILED (2 rows)" in quality.enforce(results)
    with pytest.raises(quality.QualityError, match="positive_prices"):
        quality.enforce(results, strict=True)


def test_one_pass_over_the_table(spark, dirty, tmp_path):
    path = str(tmp_path / "t")
    dirty.write.parquet(path)
    plan = quality.silver_quality(spark.read.parquet(path))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("FileScan") == 1 and "partial_count" in text
