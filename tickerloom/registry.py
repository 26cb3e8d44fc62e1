"""Every table, view, query and check by name, bound to the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Queries up to the features compute
from the raw tables, with the macro observations drawn from them once. Those above read the stored
silver, gold and snapshot tables, as they would in production. A stored table is built once per
application and data directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import bindings, schemas
from .operators import asof
from .operators.rank import Ranking, sliced_rank
from .plans import analytics, charts, comoments, gold, pipeline, quality, views
from .plans.silver import price_with_macro
from .session import scratch_path
from .settings import DEFAULT_SERIES as SERIES, Universe
from .sources import bronze, tables
from .streaming.landing import follow_prices

Query = Callable[[SparkSession, str], DataFrame]

ROLES = bindings.ROLES
UNIVERSE = Universe()   # every landed symbol
LAYOUT = tables.Layout(buckets=2, yearly=True)
SERIES_FOLDER = r"series_id=([^/]+)/"
_stored: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def _store(spark: SparkSession, sf_dir: str, name: str, build: Query, layout: tables.Layout | None = None) -> tables.Table:
    """The stored table ``name``, built on first use and again if its folder was cleared."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored or not tables.table_exists(spark, _stored[key][0]):
        df, path = build(spark, sf_dir), scratch_path(spark, name)
        if layout:
            tables.write_partitioned(df, path, layout)
        else:
            tables.write_snapshot(df, path)
        _stored[key] = (path, df.schema)
    path, schema = _stored[key]
    return tables.Table(spark, path, schema, layout)


def macro_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations, a small table however many orders they are drawn from."""
    return _store(spark, sf_dir, "observations", bindings.observations).rows()


def silver(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    bars = bindings.bars(spark, sf_dir, grain)
    return price_with_macro(bars, macro_table(spark, sf_dir), SERIES)


def features(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    return gold.daily_features(silver(spark, sf_dir, grain))


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir, "silver", silver, LAYOUT).rows()


def gold_table(spark: SparkSession, sf_dir: str) -> tables.Table:
    """The stored features, laid out as the jobs lay them out."""
    return _store(
        spark, sf_dir, "gold", lambda *at: gold.daily_features(silver_table(*at)), LAYOUT
    )


def summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(
        spark, sf_dir, "summary", lambda *at: gold.symbol_summary(gold_table(*at).rows())
    ).rows()


_names: dict[tuple[str, str], list[str]] = {}


def symbol_names(spark: SparkSession, sf_dir: str) -> list[str]:
    """The symbols of the stored tables, asked for once per application and data directory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _names:
        _names[key] = bindings.symbols(spark, sf_dir)
    return _names[key]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals for statistics whose last bits depend on the order of addition."""
    return df.withColumns({name: F.round(name, 6) for name in columns})


def _newest(df: DataFrame) -> Column:
    return df.agg(F.max("date")).scalar()


def _feature_group(*columns: str) -> Query:
    """One group of features; Catalyst leaves out every window the others would need."""
    vol = [c for c in columns if c.startswith("vol_")]
    return lambda spark, sf_dir: rounded(
        features(spark, sf_dir).select("symbol", "date", *columns), *vol
    )


def _on_gold(build: Callable[[tables.Table], DataFrame], *inexact: str) -> Query:
    return lambda spark, sf_dir: rounded(build(gold_table(spark, sf_dir)), *inexact)


def macro_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The macro values known on every trading day."""
    days = bindings.bars(spark, sf_dir).select("date").distinct()
    return asof.join_asof(days, macro_table(spark, sf_dir), SERIES)


def macro_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The macro values that were published by every trading day, revisions included once they were out."""
    days = bindings.bars(spark, sf_dir).select("date").distinct()
    told = _store(spark, sf_dir, "vintages", bindings.vintages).rows()
    return asof.join_asof(days, told, SERIES, point_in_time=True)


def daily_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of every symbol ranked by return, with the rank cut into slices."""
    rows = gold_table(spark, sf_dir).rows().select("symbol", "date", "return_21d")
    ranking = Ranking("return_21d", "rank_return_1m", descending=True)
    return sliced_rank(rows, ranking)


def upsert_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History up to a month ago, then a batch that corrects one month and adds another."""
    rows = silver_table(spark, sf_dir)
    newest = _newest(rows)
    batch = rows.filter(F.col("date") > F.add_months(newest, -2)).withColumn(
        "volume", F.col("volume") + 1
    )
    path = scratch_path(spark, "upsert-daily")
    history = rows.filter(F.col("date") <= F.add_months(newest, -1))
    tables.upsert(history, path, LAYOUT, staged=True)
    tables.upsert(batch, path, LAYOUT, staged=True)
    return tables.scan(spark, path, rows.schema, LAYOUT)


def upsert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month-old snapshot, then the symbols that traded on the last day."""
    rows = gold_table(spark, sf_dir).rows()
    newest = _newest(rows)
    path = scratch_path(spark, "upsert-summary")
    old = gold.symbol_summary(rows.filter(F.col("date") <= F.add_months(newest, -1)))
    tables.upsert_snapshot(old, path)
    tables.upsert_snapshot(gold.symbol_summary(rows.filter(F.col("date") == newest)), path)
    return rounded(spark.read.schema(old.schema).parquet(path), "vol_ann_1m")


def _landing(spark: SparkSession, sf_dir: str) -> bronze.Documents:
    path = scratch_path(spark, "landed-prices")
    bindings.land_prices(bindings.bars(spark, sf_dir), path)
    bindings.land_errors(spark, sf_dir, path)
    return bronze.price_documents(spark, path, lines=True)


def bronze_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars landed twice as JSON; the later landing of each symbol and year wins."""
    documents = _landing(spark, sf_dir).good
    entity = F.concat_ws("/", F.lower("symbol"), F.substring(F.col("values")[0]["datetime"], 1, 4))
    batch = F.regexp_extract("file_path", r"batch=(\d+)/", 1).cast("int")
    return bronze.prices(bronze.latest(documents, entity, batch))


def bronze_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landed-macro")
    bindings.land_observations(bindings.observation_grid(spark, sf_dir), path)
    documents = bronze.macro_documents(spark, path, lines=True)
    return bronze.observations(documents, list(SERIES), SERIES_FOLDER)


def silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job over bars landed twice, errors and broken files among them."""
    root = scratch_path(spark, "silver-job")
    bindings.land_prices(bindings.bars(spark, sf_dir), f"{root}/prices")
    bindings.land_errors(spark, sf_dir, f"{root}/prices")
    bindings.land_observations(bindings.observation_grid(spark, sf_dir), f"{root}/macro")
    bindings.land_broken_observations(spark, sf_dir, f"{root}/macro")
    path = f"{root}/silver"
    pipeline.run_silver(
        spark, f"{root}/prices", f"{root}/macro", path, UNIVERSE, LAYOUT, lines=True,
        series_pattern=SERIES_FOLDER, strict=True,
    )
    return tables.scan(spark, path, schemas.silver(UNIVERSE.macro_columns), LAYOUT)


def gold_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold job over a written silver table, run twice."""
    root = scratch_path(spark, "gold-job")
    paths = [f"{root}/{name}" for name in ("silver", "features", "summary")]
    tables.upsert(silver_table(spark, sf_dir), paths[0], LAYOUT, staged=True)
    for _ in range(2):
        pipeline.run_gold(spark, *paths, UNIVERSE, LAYOUT, strict=True)
    written, _ = pipeline.gold_tables(spark, paths[1], paths[2], UNIVERSE, LAYOUT)
    return rounded(written, *schemas.VOLATILITY)


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features kept up to date from a ledger. A history that lacks its last month and is wrong in the one
    before is landed and computed; a correction and the rest follow in two silver runs before the next
    gold run; then both jobs run again with nothing new."""
    root = scratch_path(spark, "gold-incremental")
    paths = [f"{root}/{name}" for name in ("silver", "features", "summary")]
    book = f"{root}/ledger"
    rows = bindings.bars(spark, sf_dir)
    newest = _newest(rows)
    wrong = F.col("date") > F.add_months(newest, -2)
    history = rows.filter(F.col("date") <= F.add_months(newest, -1)).withColumns({
        "close": F.when(wrong, F.col("close") + 1).otherwise(F.col("close")),
        "volume": F.when(wrong, F.col("volume") + 1).otherwise(F.col("volume")),
    })
    bindings.land_observations(bindings.observation_grid(spark, sf_dir), f"{root}/macro")

    def follow() -> list[str]:
        return pipeline.run_silver(
            spark, f"{root}/prices", f"{root}/macro", paths[0], UNIVERSE, LAYOUT, lines=True,
            series_pattern=SERIES_FOLDER, ledger_path=book)

    for n, (batch, computed) in enumerate([
        (history, True),
        (rows.filter(wrong & (F.col("date") <= F.add_months(newest, -1))), False),
        (rows.filter(F.col("date") > F.add_months(newest, -1)), True),
        (None, True),
    ]):
        if batch is not None:
            bindings.land_prices(batch, f"{root}/prices/part={n}")
        follow()
        if computed:
            pipeline.run_gold(spark, *paths, UNIVERSE, LAYOUT, ledger_path=book)
    written, _ = pipeline.gold_tables(spark, paths[1], paths[2], UNIVERSE, LAYOUT)
    return rounded(written, *schemas.VOLATILITY)


def silver_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> DataFrame:
    """Silver from a stream over the landing folder: half the years first, the rest later."""
    root = scratch_path(spark, "silver-stream")
    bars, path = bindings.bars(spark, sf_dir), f"{root}/silver"
    for n, part in enumerate((F.year("date") < 1998, F.year("date") >= 1998)):
        bindings.land_prices(bars.filter(part), f"{root}/prices/part={n}")
        follow_prices(
            spark, f"{root}/prices", macro_table(spark, sf_dir), path, f"{root}/progress",
            UNIVERSE, LAYOUT, lines=True, files_per_batch=files_per_batch,
        ).awaitTermination()
    return tables.scan(spark, path, schemas.silver(UNIVERSE.macro_columns), LAYOUT)


def gold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that follow a stream: half the years first, the rest after a restart."""
    root = scratch_path(spark, "gold-stream")
    bars, gold_paths = bindings.bars(spark, sf_dir), (f"{root}/features", f"{root}/summary")
    for n, part in enumerate((F.year("date") < 1996, F.year("date") >= 1996)):
        bindings.land_prices(bars.filter(part), f"{root}/prices/part={n}")
        follow_prices(
            spark, f"{root}/prices", macro_table(spark, sf_dir), f"{root}/silver", f"{root}/progress",
            UNIVERSE, LAYOUT, lines=True, ledger_path=f"{root}/ledger", gold_paths=gold_paths,
        ).awaitTermination()
    written, _ = pipeline.gold_tables(spark, *gold_paths, UNIVERSE, LAYOUT)
    return rounded(written, *schemas.VOLATILITY)


def correlation_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correlation matrix from stored sums: of a history up to a month ago, then of its last month."""
    features = gold_table(spark, sf_dir)
    newest = features.rows().agg(F.max("date")).first()[0]
    root = scratch_path(spark, "correlation-kept")
    growing = features._replace(path=f"{root}/features")
    tables.upsert(features.rows().filter(F.col("date") <= F.add_months(F.lit(newest), -1)), growing.path, LAYOUT)
    comoments.refresh(growing, f"{root}/sums")
    last = features.rows().filter(F.col("date") > F.add_months(F.lit(newest), -1))
    tables.upsert(last, growing.path, LAYOUT)
    comoments.refresh(growing, f"{root}/sums", last.agg(F.min("date")).first()[0])
    kept = comoments.correlation(spark, f"{root}/sums")
    return rounded(kept.select(F.col("symbol_b").alias("row_symbol"), F.col("symbol_a").alias("column_symbol"), "correlation"), "correlation")


def bronze_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected documents of both kinds, by reason."""
    path = scratch_path(spark, "landed-macro")
    bindings.land_observations(bindings.observation_grid(spark, sf_dir), path)
    bindings.land_broken_observations(spark, sf_dir, path)
    macro = bronze.rejected(bronze.macro_documents(spark, path, lines=True))
    both = _landing(spark, sf_dir).rejected.withColumn("kind", F.lit("prices")).unionByName(
        macro.withColumn("kind", F.lit("macro")))
    return both.groupBy("kind", "reason", "code", "message").agg(F.count(F.lit(1)).alias("documents"))


def _view(name: str, *inexact: str) -> Query:
    """One of the views that SQL users query, through ``spark.sql``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = gold_table(spark, sf_dir)
        newest = table.rows().agg(F.max("date")).first()[0]
        views.register_views(
            spark, silver_table(spark, sf_dir), table, summary_table(spark, sf_dir), ROLES, newest
        )
        return rounded(spark.sql(f"SELECT * FROM {name}"), *inexact)
    return run


def _recent(build: Callable, *inexact: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = gold_table(spark, sf_dir)
        return rounded(build(table, _newest(table.rows())), *inexact)
    return run


QUERIES: dict[str, Query] = {
    "bars": bindings.bars,
    "macro_observations": bindings.observations,
    "macro_wide": lambda spark, sf_dir: asof.macro_wide(
        bindings.observations(spark, sf_dir), SERIES
    ),
    "macro_asof": macro_asof,
    "macro_point_in_time": macro_point_in_time,
    "silver_price_with_macro": silver,
    "returns": _feature_group(*schemas.RETURNS),
    "moving_averages": _feature_group(*schemas.TREND),
    "volatility": _feature_group(*schemas.VOLATILITY),
    "relative_volume": _feature_group("volume_rel_20d"),
    "rsi": _feature_group("rsi_14"),
    "drawdown": _feature_group("drawdown_252d"),
    "macro_changes": _feature_group(*schemas.MACRO_CHANGES),
    "daily_features": lambda spark, sf_dir: rounded(features(spark, sf_dir), *schemas.VOLATILITY),
    "daily_features_part": lambda spark, sf_dir: rounded(
        features(spark, sf_dir, "part"), *schemas.VOLATILITY
    ),
    "symbol_summary": _on_gold(lambda g: gold.symbol_summary(g.rows()), "vol_ann_1m"),
    "leaderboard": lambda spark, sf_dir: rounded(
        views.leaderboard(summary_table(spark, sf_dir), ROLES.classes), "vol_ann_1m"
    ),
    "daily_leaderboard": daily_leaderboard,
    "daily_recent": _recent(
        lambda g, newest: views.daily_recent(g, newest, ROLES.classes), "vol_ann_21d"
    ),
    "sector_comparison": _recent(
        lambda g, newest: views.sector_comparison(g, ROLES, newest), "vol_ann_21d"
    ),
    "return_correlation": _on_gold(analytics.return_correlation, "correlation"),
    "capm_beta": _on_gold(
        lambda g: analytics.capm_beta(g, ROLES.market),
        "beta", "correlation_to_spy", "naive_alpha",
    ),
    "rate_regime": _on_gold(analytics.rate_regime, "avg_return"),
    "sector_alpha": _recent(
        lambda g, newest: analytics.sector_alpha(g, ROLES, newest),
        "avg_daily_alpha", "alpha_volatility",
    ),
    "event_screen": _on_gold(analytics.event_screen, "vol_ann_21d"),
    "mean_reversion": _on_gold(analytics.mean_reversion),
    "tail_risk": _on_gold(
        lambda g: analytics.tail_risk(g, ROLES.market), "avg_return_on_bad_market_days"
    ),
    "returns_wide": lambda spark, sf_dir: charts.returns_wide(
        gold_table(spark, sf_dir), symbol_names(spark, sf_dir)
    ),
    "correlation_matrix": _on_gold(charts.correlation_matrix, "correlation"),
    "correlation_kept": correlation_kept,
    "correlation_range": _on_gold(
        charts.correlation_range, "min_correlation", "max_correlation"
    ),
    "beta_flagged": _on_gold(lambda g: charts.beta_flagged(g, ROLES.market), "beta"),
    "regime_wide": _on_gold(charts.regime_wide, "easing", "stable", "tightening"),
    "alpha_flagged": _recent(
        lambda g, newest: charts.alpha_flagged(g, ROLES, newest),
        "avg_daily_alpha", "alpha_volatility",
    ),
    "event_labels": _on_gold(charts.event_labels),
    "bad_day_returns": _on_gold(
        lambda g: charts.bad_day_returns(g, ROLES.market), "avg_return_on_bad_days"
    ),
    "silver_quality": lambda spark, sf_dir: quality.silver_quality(bindings.bars(spark, sf_dir)),
    "tick_quality": lambda spark, sf_dir: quality.silver_quality(bindings.ticks(spark, sf_dir)),
    "gold_quality": _on_gold(lambda g: quality.gold_quality(g.rows())),
    "view_silver_price_with_macro": _view("silver_price_with_macro"),
    "view_gold_daily_features": _view("gold_daily_features", *schemas.VOLATILITY),
    "view_gold_symbol_summary": _view("gold_symbol_summary", "vol_ann_1m"),
    "view_gold_daily_recent": _view("gold_daily_recent", "vol_ann_21d"),
    "view_gold_sector_comparison": _view("gold_sector_comparison", "vol_ann_21d"),
    "view_gold_leaderboard": _view("gold_leaderboard", "vol_ann_1m"),
    "upsert_daily": upsert_daily,
    "upsert_summary": upsert_summary,
    "silver_job": silver_job,
    "gold_job": gold_job,
    "gold_incremental": gold_incremental,
    "silver_stream": silver_stream,
    "gold_stream": gold_stream,
    "bronze_prices": bronze_prices,
    "bronze_macro": bronze_macro,
    "bronze_rejected": bronze_rejected,
}
