"""Times the headline queries and prints one JSON line.

Every query is run once to warm up, then ``BENCH_RUNS`` times; the median counts. ``gold_build`` is
the whole path from raw tables to the stored features that the analytical queries then read; it is one
cold run and is reported apart from the sum, as ``cold``. The jobs and the stream write whole tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickerloom import registry  # noqa: E402
from tickerloom.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = [
    "bars", "macro_asof", "silver_price_with_macro", "daily_features", "daily_features_part",
    "symbol_summary", "leaderboard", "sector_comparison", "return_correlation", "capm_beta",
    "rate_regime", "sector_alpha", "event_screen", "mean_reversion", "tail_risk", "returns_wide",
    "silver_quality", "gold_quality", "upsert_daily", "bronze_prices",
    "silver_job", "gold_job", "gold_incremental", "silver_stream",
]
ONCE = {"silver_job", "gold_job", "gold_incremental", "silver_stream", "gold_stream"}   # timed once, after a warm-up


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "tickerloom-bench", f"local[{CPUS}]",
        **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
           "spark.sql.shuffle.partitions": CPUS},
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or HEADLINES
    cold = {"gold_build": round(seconds(lambda: registry.gold_table(spark, SF_DIR)), 3)}
    times = {}
    for name in only:
        query = registry.QUERIES[name]
        consume(query(spark, SF_DIR))
        times[name] = [seconds(lambda: consume(query(spark, SF_DIR))) for _ in range(1 if name in ONCE else RUNS)]
    medians = {name: round(statistics.median(t), 3) for name, t in times.items()}
    print(json.dumps({
        "metric": "sum of warm medians",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "cold": cold,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
