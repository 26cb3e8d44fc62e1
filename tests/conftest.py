import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickerloom import schemas  # noqa: E402
from tickerloom.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tickerloom-tests", "local[8]",
        **{"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_prices(spark):
    """Price rows from (symbol, day, close) or (symbol, day, o, h, l, c, volume)."""
    def make(rows):
        full = [r if len(r) == 7 else (r[0], r[1], r[2], r[2], r[2], r[2], 100) for r in rows]
        return spark.createDataFrame(full, schemas.PRICES)
    return make


@pytest.fixture
def make_silver(make_prices):
    from pyspark.sql import functions as F

    def make(rows):
        return make_prices(rows).withColumns(
            {c: F.lit(None).cast("double") for c in ("cpi", "fedFundsRate", "treasury10y")}
        )
    return make


def jan(day: int) -> date:
    return date(2024, 1, day)


def as_dicts(df, *order):
    rows = [row.asDict() for row in df.collect()]
    return sorted(rows, key=lambda r: tuple(r[c] for c in order)) if order else rows


def rows_of(df):
    """Order-free contents."""
    return sorted(map(repr, (tuple(row) for row in df.collect())))
