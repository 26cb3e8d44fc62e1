"""What every silver run read and changed, kept until all who follow have dealt with it.

A ledger is a folder with one numbered entry per run, and nothing in it is ever overwritten. An entry
holds Parquet tables: ``files``, the landed files that were read; ``changes``, the keys whose stored row
is about to change; ``observations``, the macro values the run joined. It goes through two markers:

* ``_prepared`` once all its tables are written, before the silver table is touched;
* ``_committed`` once the silver table holds the changes, or ``_abandoned`` if the run died in between,
  which the next run finds out, since a table has one writer at a time.

So whatever happens to a run, the keys it may have changed are on record. Files count as read only in
committed entries: those of a run that died are read again.

Followers, such as the gold job, work off the changes after their mark. They are given every prepared
entry, also one that is not settled yet, but the mark only moves up to the last entry before which all
are settled, and only after the follower has written its result. A follower that dies, or reads an entry
too early, is given it again; recomputing a key twice does no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..session import delete, hadoop

PREPARED, COMMITTED, ABANDONED = "_prepared", "_committed", "_abandoned"
WHOLE = "_whole"   # the entry's files are all that count as read
# After so many entries with files the next one repeats the whole list, so reading it stays short.
WHOLE_EVERY = 64
FILES = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("size", T.LongType()),
    T.StructField("universe", T.StringType()),
])


@dataclass(frozen=True)
class Pending:
    """Changes a follower has not dealt with; none if ``changes`` is None. ``mark`` is where it will stand."""

    changes: DataFrame | None
    mark: int


class Entry:
    """One run's entry while it is being written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}")

    def mark(self, name: str) -> None:
        fs, location = hadoop(self.spark, f"{self.path}/{name}")
        fs.create(location, True).close()

    def prepare(self) -> None:
        self.mark(PREPARED)

    def commit(self) -> None:
        self.mark(COMMITTED)


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self, name: str) -> list[int]:
        """The entries that have something of this name, in order."""
        fs, pattern = hadoop(self.spark, f"{self.path}/entry=*/{name}")
        found = fs.globStatus(pattern) or []
        return sorted(int(f.getPath().getParent().getName().removeprefix("entry=")) for f in found)

    def _entry(self, number: int) -> str:
        return f"{self.path}/entry={number:010d}"

    def begin(self) -> Entry:
        """A new entry. What a run that died has left is settled first."""
        settled = {*self._numbers(COMMITTED), *self._numbers(ABANDONED)}
        prepared = set(self._numbers(PREPARED))
        for number in prepared - settled:
            Entry(self.spark, self._entry(number)).mark(ABANDONED)
        begun = self._all()
        for number in set(begun) - prepared:
            delete(self.spark, self._entry(number))   # died before it touched silver
        return Entry(self.spark, self._entry(max(begun, default=0) + 1))

    def _all(self) -> list[int]:
        fs, pattern = hadoop(self.spark, f"{self.path}/entry=*")
        return sorted(int(f.getPath().getName().removeprefix("entry=")) for f in (fs.globStatus(pattern) or []))

    def _read(self, name: str, numbers: list[int], schema: T.StructType) -> DataFrame | None:
        paths = [f"{self._entry(n)}/{name}" for n in numbers]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def files(self) -> tuple[DataFrame | None, bool]:
        """The landed files that count as read, and whether the next entry should repeat them all."""
        done = set(self._numbers(COMMITTED))
        whole = max((n for n in self._numbers(WHOLE) if n in done), default=0)
        numbers = [n for n in self._numbers("files") if n in done and n >= whole]
        return self._read("files", numbers, FILES), len(numbers) >= WHOLE_EVERY

    def observations(self, schema: T.StructType) -> DataFrame | None:
        """The macro values that silver was last joined with."""
        done = set(self._numbers(COMMITTED))
        last = [n for n in self._numbers("observations") if n in done][-1:]
        return self._read("observations", last, schema)

    def mark_of(self, follower: str) -> int:
        fs, pattern = hadoop(self.spark, f"{self.path}/_marks/{follower}/*")
        return max((int(f.getPath().getName()) for f in (fs.globStatus(pattern) or [])), default=0)

    def pending(self, follower: str, schema: T.StructType, upto: int | None = None) -> Pending:
        """``upto``: the mark of another follower that has to go first."""
        mark = self.mark_of(follower)
        prepared = [n for n in self._numbers(PREPARED) if n > mark and (upto is None or n <= upto)]
        # Markers are read after the entries: one that is settled meanwhile is merely given again.
        settled = {*self._numbers(COMMITTED), *self._numbers(ABANDONED)} & set(prepared)
        open_ = [n for n in prepared if n not in settled]
        settled_to = max((n for n in prepared if not open_ or n < open_[0]), default=mark)
        return Pending(self._read("changes", prepared, schema), settled_to)

    def move(self, follower: str, mark: int) -> None:
        """The follower has dealt with everything up to ``mark``; a mark never goes back."""
        before = self.mark_of(follower)
        if mark <= before:
            return
        fs, location = hadoop(self.spark, f"{self.path}/_marks/{follower}/{mark:010d}")
        fs.create(location, True).close()
        if before:
            delete(self.spark, f"{self.path}/_marks/{follower}/{before:010d}")
