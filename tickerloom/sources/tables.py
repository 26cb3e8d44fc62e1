"""Parquet tables: scan, first write, and upsert by key.

Parquet has no row-level merge. An upsert rewrites only the partitions its batch touches, through
dynamic partition overwrite: all new files are complete before the first old partition is replaced, so
a job that fails while it computes leaves the table as it was. Partitions are then replaced one after
another; a driver lost in that moment leaves some old and some new, and the same upsert run again
completes them. The swap is not atomic for concurrent readers, and there must be one writer at a time.

A table keeps its schema in ``_schema.json``. A batch must bring every column of the table with its
type; a new column is added only when the caller says so.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import KEY
from ..session import Staging, hadoop

# Partitions of a batch that are listed in a scan filter. A batch that touches more is about to rewrite
# much of the table anyway; its target is read through a semi-join, with the same result.
PRUNE_LIMIT = 10_000
SCHEMA_FILE = "_schema.json"


class DuplicateKeyError(ValueError):
    """A batch holds the same key more than once."""


class SchemaChangeError(ValueError):
    """A batch lacks a column of its table, has it with another type, or brings a new one."""


@dataclass(frozen=True)
class Layout:
    """How a table is cut into directories.

    Without ``buckets``, one directory per symbol. With it, symbols are hashed into that many
    directories instead, which keeps files large when there are thousands of symbols. With
    ``yearly``, each is cut by year as well, so a daily batch rewrites one year, not the history.
    The jobs use ``DAILY``: at 20,000 symbols a directory of it holds some 75 MB.
    """

    buckets: int | None = None
    yearly: bool = False

    @property
    def derived(self) -> dict[str, Column]:
        columns = {}
        if self.buckets:
            columns["bucket"] = self.bucket(F.col("symbol"))
        if self.yearly:
            columns["year"] = F.year("date")
        return columns

    @property
    def names(self) -> list[str]:
        return ([] if self.buckets else ["symbol"]) + list(self.derived)

    def bucket(self, symbol: Column) -> Column:
        return F.pmod(F.xxhash64(symbol), F.lit(self.buckets)).cast("int")

    def stored(self, schema: T.StructType) -> T.StructType:
        extra = [T.StructField(name, T.IntegerType()) for name in self.derived]
        return T.StructType([*schema.fields, *extra])

    def place(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.derived) if self.derived else df


BY_SYMBOL = Layout()
DAILY = Layout(buckets=16, yearly=True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a completely written table.

    Data without the success marker is somebody else's or a broken first write. It raises, so that
    nothing is overwritten by mistake.
    """
    fs, location = hadoop(spark, path)
    if not fs.exists(location):
        return False
    if fs.exists(hadoop(spark, f"{path}/_SUCCESS")[1]):
        return True
    visible = [f.getPath().getName() for f in fs.listStatus(location)]
    if any(not name.startswith(("_", ".")) for name in visible):
        raise ValueError(f"{path} holds data but no success marker")
    return False


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    layout: Layout | None = DAILY,
    symbols: Sequence[str] | None = None,
    since: dt.date | Column | None = None,
    until: dt.date | Column | None = None,
) -> DataFrame:
    """Read a table. ``symbols`` prune directories under every layout, ``since`` and ``until`` under a yearly one.

    The explicit schema keeps symbols such as ``007`` text and spares schema inference.
    """
    stored = layout.stored(schema) if layout else schema
    df = spark.read.schema(stored).parquet(path)
    if symbols is not None:
        df = df.filter(F.col("symbol").isin(*symbols))
        if layout and layout.buckets:
            df = df.filter(F.col("bucket").isin(*[layout.bucket(F.lit(s)) for s in symbols]))
    for end, within in ((since, Column.__ge__), (until, Column.__le__)):
        if end is not None:
            end = end if isinstance(end, Column) else F.lit(end)
            df = df.filter(within(F.col("date"), end))
            if layout and layout.yearly:
                df = df.filter(within(F.col("year"), F.year(end)))
    return df.select(*schema.names)


class Table(NamedTuple):
    """A stored table; views and queries name the days and symbols they need of it."""

    spark: SparkSession
    path: str
    schema: T.StructType
    layout: Layout = DAILY

    def rows(
        self,
        symbols: Sequence[str] | None = None,
        since: dt.date | Column | None = None,
        until: dt.date | Column | None = None,
    ) -> DataFrame:
        return scan(self.spark, self.path, self.schema, self.layout, symbols, since, until)


def rows_of(
    source: DataFrame | Table,
    symbols: Sequence[str] | None = None,
    since: dt.date | Column | None = None,
) -> DataFrame:
    """Rows of a stored table, with its directories pruned, or of any DataFrame."""
    if isinstance(source, Table):
        return source.rows(symbols, since)
    if symbols is not None:
        source = source.filter(F.col("symbol").isin(*symbols))
    return source if since is None else source.filter(F.col("date") >= since)


def _arranged(df: DataFrame, layout: Layout, key: Sequence[str]) -> DataFrame:
    """Rows gathered by directory. AQE splits a hot directory and merges small ones."""
    return df.hint("rebalance", *layout.names).sortWithinPartitions(*layout.names, *key)


def write_partitioned(
    df: DataFrame, path: str, layout: Layout = DAILY, key: Sequence[str] = tuple(KEY)
) -> None:
    """First write: replaces whatever is at ``path``, schema included."""
    placed = _arranged(layout.place(df), layout, key)
    placed.write.mode("overwrite").partitionBy(*layout.names).parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """First write of an unpartitioned table, schema included."""
    df.write.mode("overwrite").parquet(path)


def require_unique(df: DataFrame, key: Sequence[str]) -> None:
    repeated = df.groupBy(*key).count().filter(F.col("count") > 1).limit(3).collect()
    if repeated:
        examples = ", ".join(str(tuple(row[k] for k in key)) for row in repeated)
        raise DuplicateKeyError(f"repeated key {tuple(key)}: {examples}")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality in which NULL equals NULL, so that repeating a batch changes nothing."""
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def merged(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """All of ``batch`` plus the rows of ``target`` whose key it does not hold."""
    keys = batch.select(*[F.col(k).alias(k) for k in key])
    kept = target.join(keys, _same(target, keys, key), "left_anti")
    return kept.unionByName(batch)


def _touched(target: DataFrame, batch: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``target`` in the directories that ``batch`` has rows for."""
    places = batch.select(*names).distinct()
    listed = places.limit(PRUNE_LIMIT + 1).collect()
    if len(listed) > PRUNE_LIMIT:
        return target.join(places, _same(target, places, names), "left_semi")
    for name in names:
        values = {row[name] for row in listed}
        known = F.col(name).isin(*[v for v in values if v is not None])
        target = target.filter(known | F.col(name).isNull() if None in values else known)
    if len(names) == 1:
        return target
    return target.join(F.broadcast(places), _same(target, places, names), "left_semi")


def _remember(spark: SparkSession, path: str, schema: T.StructType) -> None:
    fs, location = hadoop(spark, f"{path}/{SCHEMA_FILE}")
    out = fs.create(location, True)
    out.write(bytearray(schema.json().encode()))
    out.close()


def stored_schema(spark: SparkSession, path: str, without: Sequence[str] = ()) -> T.StructType:
    """The columns of a table, as remembered or else as its files have them."""
    fs, location = hadoop(spark, f"{path}/{SCHEMA_FILE}")
    if fs.exists(location):
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(location), "UTF-8")
        return T.StructType.fromJson(json.loads(text))
    read = spark.read.option("mergeSchema", True).parquet(path).schema
    return T.StructType([f for f in read.fields if f.name not in without])


def _require_columns(stored: T.StructType, batch: T.StructType, add_columns: bool, path: str) -> None:
    have = {f.name: f.dataType for f in batch.fields}
    wrong = [f"{f.name} is missing" for f in stored.fields if f.name not in have]
    wrong += [f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}"
              for f in stored.fields if f.name in have and have[f.name] != f.dataType]
    if not add_columns:
        known = set(stored.names)
        wrong += [f"{name} is new" for name in batch.names if name not in known]
    if wrong:
        raise SchemaChangeError(f"batch for {path}: {'; '.join(wrong)}")


def _first(spark: SparkSession, path: str, write, schema: T.StructType) -> None:
    """Write beside ``path``, then move there: a first write that dies can simply be run again."""
    fs, location = hadoop(spark, path)
    new = f"{path.rstrip('/')}__first"
    write(new)
    _remember(spark, new, schema)
    fs.mkdirs(location.getParent())
    fs.delete(location, True)   # no table: at most an empty folder
    fs.rename(hadoop(spark, new)[1], location)


def upsert(
    batch: DataFrame,
    path: str,
    layout: Layout = DAILY,
    key: Sequence[str] = tuple(KEY),
    staged: bool = False,
    unique: bool = False,
    add_columns: bool = False,
) -> None:
    """Replace rows with a matching key, insert the others, keep all else; create if absent.

    ``batch`` is written once to the shared folder first unless it already is a stored table
    (``staged``), so its checks and the merge read the same rows without recomputing them; the copy is
    deleted at the end. ``unique`` says that its keys have been checked.
    """
    spark = batch.sparkSession
    with Staging(spark) as stage:
        batch = batch if staged else stage(batch, "batch")
        if not unique:
            require_unique(batch, key)
        if not table_exists(spark, path):
            _first(spark, path, lambda new: write_partitioned(batch, new, layout, key), batch.schema)
            return
        partitioned = [n for n in layout.names if n not in batch.columns]
        stored = stored_schema(spark, path, partitioned)
        _require_columns(stored, batch.schema, add_columns, path)
        target = spark.read.schema(layout.stored(batch.schema)).parquet(path)
        placed = layout.place(batch)
        result = merged(_touched(target, placed, layout.names), placed, key)
        (
            _arranged(result.select(*placed.columns), layout, key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*layout.names)
            .parquet(path)
        )
        if set(batch.columns) != set(stored.names):
            _remember(spark, path, batch.schema)


def changed_rows(batch: DataFrame, path: str, layout: Layout = DAILY) -> DataFrame:
    """Rows of ``batch`` that the table does not hold, or holds with other values.

    An upsert of these alone leaves the table as one of the whole batch would, and every directory
    without such a row keeps its files.
    """
    spark = batch.sparkSession
    if not table_exists(spark, path):
        return batch
    partitioned = [n for n in layout.names if n not in batch.columns]
    _require_columns(stored_schema(spark, path, partitioned), batch.schema, False, path)
    target = _touched(spark.read.schema(layout.stored(batch.schema)).parquet(path), layout.place(batch), layout.names)
    known = target.select(*batch.columns)
    return batch.join(known, _same(batch, known, batch.columns), "left_anti")


def changed_since(batch: DataFrame, path: str, layout: Layout = DAILY, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Keys of the changed rows."""
    return changed_rows(batch, path, layout).select(*key)


def _swap(spark: SparkSession, new: str, path: str) -> None:
    fs, location = hadoop(spark, path)
    aside = hadoop(spark, f"{path}__previous")[1]
    fs.delete(aside, True)
    fs.rename(location, aside)
    fs.rename(hadoop(spark, new)[1], location)
    fs.delete(aside, True)


def recover_snapshot(spark: SparkSession, path: str) -> None:
    """Put the previous snapshot back if a run stopped between the two renames of a swap."""
    fs, location = hadoop(spark, path)
    aside = hadoop(spark, f"{path}__previous")[1]
    if fs.exists(aside) and not fs.exists(location):
        fs.rename(aside, location)


def upsert_snapshot(
    batch: DataFrame,
    path: str,
    key: Sequence[str] = ("symbol",),
    staged: bool = False,
    add_columns: bool = False,
) -> None:
    """Upsert into an unpartitioned table: write the result beside it, then swap the two."""
    spark = batch.sparkSession
    with Staging(spark) as stage:
        batch = batch if staged else stage(batch, "snapshot")
        require_unique(batch, key)
        recover_snapshot(spark, path)
        if not table_exists(spark, path):
            _first(spark, path, lambda new: write_snapshot(batch, new), batch.schema)
            return
        _require_columns(stored_schema(spark, path), batch.schema, add_columns, path)
        target = spark.read.schema(batch.schema).parquet(path)
        new = f"{path}__next"
        write_snapshot(merged(target, batch, key).select(*batch.columns), new)
        _remember(spark, new, batch.schema)
        _swap(spark, new, path)
