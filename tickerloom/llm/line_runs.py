"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` keeps runs of ``(h1, h2, n_docs, top_doc)`` under a folder that all executors share: a
line's 128-bit key hash, in how many documents it occurs and the largest id among them. A new batch is
merge-anti-joined with the runs: keys that no run holds become the batch's own run at level 0, so runs
never share a key; for keys that one holds, the batch leaves an increment. As soon as a level holds
``fanout`` runs they are merged into one of the next level, and increments are summed up alike. Runs
are sorted by hash. Once all batches are in, runs and increments together say which keys are frequent
and who keeps their lines, which no batch can know by itself. A sort-merge join on the hash finds the lines that match
a frequent key and do not belong to that document; survivors are far more than repeats, so the join brings
back the repeats' positions and the rest of the text stays as it is.

A key is the line with ASCII blanks stripped at both ends and A-Z in lower case. Counting is
pre-aggregated before the shuffle, so a line that a third of all documents share costs one row per
task. Texts are shuffled once, by ``doc_id``.

Defined cases: NULL or empty text is one empty line; a NULL ``doc_id`` loses no line and counts for
nothing; several rows with one ``doc_id`` are one document and all lose or keep their lines alike;
ties do not exist, the largest ``doc_id`` keeps a line, each time it holds it; an empty table gives
an empty result; other columns are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import Staging, delete, scratch_path, stage

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_keys(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """``(doc_id, pos, h1, h2)`` of every line whose key has at least ``min_chars`` code points."""
    lines = (docs.filter(F.col("doc_id").isNotNull())
             .select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
             .select("doc_id", "pos", key_of(F.col("line")).alias("key"))
             .filter(F.char_length("key") >= min_chars))
    # Two differently seeded hashes: 128 bits, of which no two lines of a corpus agree by chance.
    return lines.select("doc_id", "pos", F.xxhash64("key").alias("h1"),
                        F.xxhash64(F.lit(7), F.col("key")).alias("h2"))


class LineRuns:
    """The runs of one index, as paths by level, and the increments. Each is a Parquet table of its own."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = [[]]
        self.increments: list[str] = []

    def _write(self, rows: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, name)
        rows.select(*_HASH, "n_docs", "top_doc").sortWithinPartitions(*_HASH).write.parquet(path)
        return path

    def _runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def _sum(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.parquet(*paths)
        return rows.groupBy(*_HASH).agg(F.sum("n_docs").alias("n_docs"), F.max("top_doc").alias("top_doc")) if len(paths) > 1 else rows

    def add(self, lines: DataFrame) -> None:
        """The lines of a batch: its unseen keys as a run, the others as an increment. A document's lines come in one batch."""
        per_doc = lines.groupBy(*_HASH, "doc_id").agg(F.lit(1).alias("n_docs"))
        batch = per_doc.groupBy(*_HASH).agg(F.sum("n_docs").alias("n_docs"), F.max("doc_id").alias("top_doc"))
        if not self._runs():
            self.levels[0].append(self._write(batch, "run-0"))
            return
        own = self._write(batch, "batch")
        counted, known = self.spark.read.parquet(own), self.spark.read.parquet(*self._runs()).select(*_HASH)
        self.levels[0].append(self._write(counted.hint("merge").join(known, _HASH, "left_anti"), "run-0"))
        self.increments.append(self._write(counted.hint("merge").join(known, _HASH, "left_semi"), "increment"))
        delete(self.spark, own)
        self.compact()

    def compact(self) -> None:
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                runs, self.levels[level] = self.levels[level], []
                while len(self.levels) <= level + 1:
                    self.levels.append([])
                self.levels[level + 1].append(self._write(self._sum(runs), f"run-{level + 1}"))
                self._delete(runs)
        if len(self.increments) >= self.fanout:
            summed, self.increments = self.increments, []
            self.increments.append(self._write(self._sum(summed), "increment"))
            self._delete(summed)

    def _delete(self, paths: list[str]) -> None:
        for path in paths:
            delete(self.spark, path)

    def close(self) -> None:
        """Deletes every run."""
        self._delete([*self._runs(), *self.increments])
        self.levels, self.increments = [[]], []

    def frequent(self, min_docs: int) -> DataFrame | None:
        """Keys of at least ``min_docs`` documents over all runs, and who keeps their lines."""
        paths = [*self._runs(), *self.increments]
        return self._sum(paths).filter(F.col("n_docs") >= min_docs).select(*_HASH, "top_doc") if paths else None


def repeats(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(doc_id, __dropped)``: the positions of a document's lines that do not survive.

    ``frequent`` is a written table, so that a hot line's rows can be split between tasks.
    """
    lost = lines.hint("merge").join(frequent, _HASH).filter(F.col("doc_id") != F.col("top_doc"))
    return lost.groupBy("doc_id").agg(F.collect_set("pos").alias("__dropped"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40,
                        batches: int = 4, fanout: int = 3) -> DataFrame:
    """``docs`` with ``_kept`` (the surviving text), ``_n_lines`` and ``_n_dropped`` added.

    ``batches`` runs are written, one after another, before any line is judged, so that the counts
    cover the whole table. Documents are dealt to batches by a hash of their id.
    """
    with Staging(docs.sparkSession) as keep:
        lines = keep(line_keys(docs, min_chars), "lines")
        runs = LineRuns(docs.sparkSession, fanout)
        try:
            for batch in range(batches):
                runs.add(lines.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == batch))
            lost = stage(repeats(lines, keep(runs.frequent(min_docs), "frequent")), "lost")
        finally:
            runs.close()
    # Sorted on both sides, so neither has to fit a task's memory, however many documents lose lines.
    lost = lost.withColumnRenamed("doc_id", "__doc").hint("merge")
    joined = docs.join(lost, F.col("doc_id") == F.col("__doc"), "left").drop("__doc")
    every = lines_of(F.col("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    return (joined.withColumn("__lines", every)
            .withColumn("_n_lines", F.size("__lines").cast("bigint"))
            .withColumn("_n_dropped", F.coalesce(F.size("__dropped"), F.lit(0)).cast("bigint"))
            .withColumn("_n_dropped", F.greatest("_n_dropped", F.lit(0).cast("bigint")))
            .withColumn("_kept", F.when(F.col("__dropped").isNull(), F.coalesce("text", F.lit("")))
                        .otherwise(F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")))
            .drop("__lines", "__dropped"))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the surviving text and its length in ``n_chars``; other columns as they were."""
    text = F.when(F.col("text").isNotNull(), F.col("_kept"))
    cleaned = drop_repeated_lines(docs, **options).withColumn("text", text)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def line_digest(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns."""
    return drop_repeated_lines(docs.select("doc_id", "text"), **options).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept"), 256).alias("kept_sha256"))


ORACLE = f"""
WITH lines AS (
    SELECT doc_id, pos, line, lower_ascii AS key FROM (
        SELECT doc_id, pos, line,
               translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         '{UPPER}', '{LOWER}') AS lower_ascii
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                     generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
              FROM documents))),
frequent AS (
    SELECT key, max(doc_id) AS top_doc FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
    SELECT l.doc_id, l.pos, l.line, coalesce(l.doc_id <> f.top_doc, false) AS lost
    FROM lines l LEFT JOIN frequent f ON l.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
