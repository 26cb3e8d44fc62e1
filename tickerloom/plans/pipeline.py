"""The two jobs: landed documents to silver, silver to gold.

Each job computes its rows once into the shared folder; checks, upsert and snapshot read those. The
copies are deleted when the job ends or fails.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import schemas
from ..operators.asof import revised_days
from ..session import Staging
from ..settings import Universe
from ..sources import bronze
from ..sources.ledger import FILES, WHOLE, Entry, Ledger
from ..sources.tables import (
    DAILY, Layout, Table, changed_rows, require_unique, scan, table_exists, upsert, upsert_snapshot,
)
from . import gold, quality
from .silver import price_with_macro

GOLD = "gold"   # the gold job's name among the followers of a ledger
KEYS = T.StructType([f for f in schemas.PRICES.fields if f.name in schemas.KEY])


def run_silver(
    spark: SparkSession,
    prices_path: str,
    macro_path: str,
    silver_path: str,
    universe: Universe = Universe(),
    layout: Layout = DAILY,
    lines: bool = False,
    series_pattern: str = bronze.ENTITY_PATTERN,
    strict: bool = False,
    ledger_path: str | None = None,
) -> list[str]:
    """Read, reject, type, join macro, check and upsert silver. Returns the report's lines.

    Landed text is parsed once, into staged tables from which usable and rejected documents are
    taken. Only rows that are new or differ from the stored ones are upserted, so directories without
    such rows keep their files.

    With ``ledger_path`` only files that are new or were replaced since the last run are parsed, and stored
    rows are joined anew where the macro values known on their day have been revised. The keys that
    change are put on record there, which is what ``run_gold`` needs to recompute no more than it must.
    """
    with Staging(spark) as stage:
        book = Ledger(spark, ledger_path) if ledger_path else None
        entry = book.begin() if book else None
        reading = _unread(spark, book, prices_path, universe, stage) if book else Reading(prices_path)
        macro = stage(bronze.macro_documents(spark, macro_path, lines).drop(schemas.CORRUPT), "macro")
        observed = stage(bronze.observations(macro, list(universe.series), series_pattern), "observations")
        if reading.paths:
            landed = stage(bronze.raw_price_documents(spark.read, reading.paths, lines).drop(schemas.CORRUPT), "prices")
        else:
            landed = spark.createDataFrame([], _PARSED)
        lines_out = [
            f"rejected_documents({row['reason']}): {row['count']}"
            for row in bronze.rejected(landed).groupBy("reason").count().orderBy("reason").collect()   # at most 3 reasons
        ] + [
            f"rejected_macro_documents({row['reason']}): {row['count']}"
            for row in bronze.rejected(macro).groupBy("reason").count().orderBy("reason").collect()
        ]
        typed = bronze.newest_prices(bronze.split(landed).good, universe.symbols)
        silver = stage(price_with_macro(typed, observed, universe.series), "silver")
        if book:
            revised = revised_rows(spark, silver_path, book, observed, universe, layout)
            if revised is not None:
                silver = stage(silver.unionByName(without_keys(revised, silver)), "silver")
        checks = quality.silver_quality(silver).collect()   # one row per check
        lines_out += quality.enforce(checks, strict)
        if not quality.unique(checks):
            require_unique(silver, schemas.KEY)
        changed = stage(changed_rows(silver, silver_path, layout), "changed")
        store_on_record(changed, silver_path, layout, entry, observed, reading)
    return lines_out


# What is staged of landed price documents.
_PARSED = T.StructType([
    *[f for f in schemas.PRICE_DOCUMENT.fields if f.name != schemas.CORRUPT],
    T.StructField("file_path", T.StringType()), T.StructField("landed_at", T.TimestampType()),
    T.StructField("reason", T.StringType()),
])


class Reading(NamedTuple):
    """What a run reads of the landing folder: all of it, some files or none; and the files that go on
    record for it, ``whole`` if they are all there are."""

    paths: str | list[str] | None = None
    files: DataFrame | None = None
    whole: bool = False


def _unread(spark: SparkSession, book: Ledger, path: str, universe: Universe, stage: Staging) -> Reading:
    """The universe is part of the record, so files are read again for symbols that were not asked for before."""
    asked = "*" if universe.symbols is None else ",".join(sorted(universe.symbols))
    files = stage(bronze.landed_files(spark, path).withColumn("universe", F.lit(asked)), "files")
    known, repeat = book.files()
    if known is None:
        return Reading(path, files, True)
    unread = stage(bronze.to_read(files, known), "unread")
    # The driver holds the list of files of every scan; here it holds that of the new ones.
    paths = [bronze.literal_path(row["file_path"]) for row in unread.select("file_path").collect()]
    return Reading(paths, files if repeat else unread, repeat)


def revised_rows(
    spark: SparkSession, silver_path: str, book: Ledger, observed: DataFrame, universe: Universe, layout: Layout
) -> DataFrame | None:
    """Stored rows of the days on which other macro values are known now than when they were joined."""
    before = book.observations(schemas.OBSERVATIONS)
    if before is None or not table_exists(spark, silver_path):
        return None
    days, last = revised_days(before, observed, universe.series)
    first, end = days.agg(F.min("day"), F.max("day")).first()
    if first is None:
        return None
    stored = Table(spark, silver_path, schemas.silver(universe.macro_columns), layout)
    rows = stored.rows(since=first, until=None if end == last else end)
    # At most a row per day of the DATE type.
    concerned = rows.join(F.broadcast(days), F.least(F.col("date"), F.lit(last)) == F.col("day"), "left_semi")
    return price_with_macro(concerned.select(*schemas.PRICES.names), observed, universe.series)


def follow_revisions(
    spark: SparkSession, silver_path: str, observed: DataFrame, universe: Universe, layout: Layout, ledger_path: str
) -> None:
    """Join stored rows anew where the macro values known on their day have been revised since the last run."""
    book = Ledger(spark, ledger_path)
    entry = book.begin()
    revised = revised_rows(spark, silver_path, book, observed, universe, layout)
    if revised is not None:
        with Staging(spark) as stage:
            changed = stage(changed_rows(stage(revised, "revised"), silver_path, layout), "changed")
            store_on_record(changed, silver_path, layout, entry, observed)


def without_keys(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """``rows`` whose key ``batch`` does not hold."""
    keys = batch.select(*[F.col(k).alias(f"_{k}") for k in schemas.KEY])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in schemas.KEY])
    return rows.join(keys, same, "left_anti")


def store_on_record(
    changed: DataFrame, silver_path: str, layout: Layout, entry: Entry | None, observed: DataFrame, reading: Reading = Reading()
) -> None:
    """Upsert rows that are known to change the table, on record before and after."""
    if entry:
        entry.write("changes", changed.select(*schemas.KEY))
        entry.write("observations", observed.select(*schemas.OBSERVATIONS.names))
        if reading.files is not None:
            entry.write("files", reading.files.select(*FILES.names))
        if reading.whole:
            entry.mark(WHOLE)
        entry.prepare()
    if not table_exists(changed.sparkSession, silver_path) or not changed.isEmpty():
        upsert(changed, silver_path, layout, staged=True, unique=True)
    if entry:
        entry.commit()


def run_gold(
    spark: SparkSession,
    silver_path: str,
    features_path: str,
    summary_path: str,
    universe: Universe = Universe(),
    layout: Layout = DAILY,
    strict: bool = False,
    changed: DataFrame | None = None,
    ledger_path: str | None = None,
) -> list[str]:
    """Compute, check and upsert the features, then the snapshot. Returns the report's lines.

    ``changed`` holds the silver keys that are new or have changed. Only their symbols are recomputed,
    from each one's first changed day on; directories without such rows keep their files. With
    ``ledger_path`` they are all the changes silver runs have put on record since the last gold run that
    finished, however many there were and whatever became of gold runs in between. Without either,
    and as long as there are no features, the whole history is computed.
    """
    silver = Table(spark, silver_path, schemas.silver(universe.macro_columns), layout)
    book = Ledger(spark, ledger_path) if ledger_path else None
    pending = book.pending(GOLD, KEYS) if book else None
    if pending and table_exists(spark, features_path) and table_exists(spark, summary_path):
        changed = pending.changes
        if changed is None:
            return []
    with Staging(spark) as stage:
        if changed is None:
            computed = gold.daily_features(silver.rows())
        else:
            first = stage(changed.groupBy("symbol").agg(F.min("date").alias("_first")), "changed")
            computed = None if first.isEmpty() else _features_from(silver, first, stage)
        lines_out = []
        if computed is not None:
            features = stage(computed, "features")
            checks = quality.gold_quality(features).collect()
            lines_out = quality.enforce(checks, strict)
            upsert(features, features_path, layout, staged=True, unique=quality.unique(checks))
            upsert_snapshot(gold.symbol_summary(features), summary_path)
    if book:
        book.move(GOLD, pending.mark)
    return lines_out


def _features_from(silver: Table, first: DataFrame, stage: Staging) -> DataFrame:
    """Features of ``first (symbol, _first)`` from each symbol's first changed day on.

    Frames and lags reach ``gold.LOOK_BACK`` rows back. They are sought in the two years before the
    earliest change; only symbols with fewer rows there have their older rows read as well.
    """
    names = silver.schema.names
    start = F.add_months(F.lit(first.agg(F.min("_first")).first()[0]), -24)
    rows = stage(_of(silver.rows(since=start), first), "recent")
    short = rows.groupBy("symbol", "_first").agg(F.count_if(F.col("date") < F.col("_first")).alias("_rows"))
    short = stage(short.filter(F.col("_rows") < gold.LOOK_BACK).select("symbol", "_first"), "short")
    if not short.isEmpty():
        rows = rows.unionByName(_of(silver.rows(until=F.date_sub(start, 1)), short))
    earlier = rows.filter(F.col("date") < F.col("_first")).withColumn(
        "_place", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
    ).filter(F.col("_place") <= gold.LOOK_BACK).drop("_place")
    needed = rows.filter(F.col("date") >= F.col("_first")).unionByName(earlier)
    return _of(gold.daily_features(needed.select(*names)), first).filter(F.col("date") >= F.col("_first")).drop("_first")


def _of(rows: DataFrame, first: DataFrame) -> DataFrame:
    """``rows`` of the symbols of ``first``, with the day beside them."""
    other = first.withColumnRenamed("symbol", "_symbol")
    return rows.join(other, F.col("symbol").eqNullSafe(F.col("_symbol"))).drop("_symbol")


def gold_tables(
    spark: SparkSession,
    features_path: str,
    summary_path: str,
    universe: Universe = Universe(),
    layout: Layout = DAILY,
) -> tuple[DataFrame, DataFrame]:
    features = scan(spark, features_path, schemas.gold(universe.macro_columns), layout)
    return features, spark.read.parquet(summary_path)
