"""Token counts from an exact histogram of encoded lengths.

Documents are encoded whole and counted by length, before anything is shuffled a task has one row per
length. Suffix sums over the histogram answer every question about a context limit: how many documents
are longer, how many tokens they hold, how many tokens remain if each is truncated. Sums run over
ranges of ``RANGE`` lengths first and then within a range, so no task sees the whole histogram in rows.

Defined cases: NULL and empty texts have length 0; repeated rows count each; ties do not exist in a
histogram; an empty table gives an empty histogram and totals of zero; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .encoding import SLICE_BYTES, encode, vocabulary_path
from .text import map_arrow, slices

RANGE = 1024


def _lengths(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary or vocabulary_path()
        for batch in slices(batches, "text", SLICE_BYTES):
            sizes = np.array([len(ids) for ids in encode(batch.column("text"), path)], np.int64)
            length, n = np.unique(sizes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(n.astype(np.int64))], names=["length", "n"])

    return run


def histogram(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``length, n_docs``, written once: every question is answered from it, not from the texts."""
    counted = map_arrow(docs.select("text"), _lengths(vocabulary), "length long, n long", rows=2000)
    return stage(counted.groupBy("length").agg(F.sum("n").alias("n_docs")), "histogram")


def suffix_sums(lengths: DataFrame) -> DataFrame:
    """For every length: documents and tokens at or above it, documents up to it with their share, and
    the tokens that remain when every document is truncated to it."""
    tokens = F.col("length") * F.col("n_docs")
    ranged = lengths.withColumn("range", F.floor(F.col("length") / RANGE)).withColumn("tokens", tokens)
    ranges = ranged.groupBy("range").agg(F.sum("n_docs").alias("range_docs"), F.sum("tokens").alias("range_tokens"))
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    ranges = ranges.select("range", *[F.coalesce(F.sum(f"range_{c}").over(above), F.lit(0)).alias(f"later_{c}") for c in ("docs", "tokens")],
                           *[F.sum(f"range_{c}").over(whole).alias(f"all_{c}") for c in ("docs", "tokens")])
    down = Window.partitionBy("range").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.join(ranges, "range").withColumns({
        "docs_at_least": F.sum("n_docs").over(down) + F.col("later_docs"),
        "tokens_at_least": F.sum("tokens").over(down) + F.col("later_tokens")})
    longer = F.col("docs_at_least") - F.col("n_docs")
    kept = F.col("all_tokens") - F.col("tokens_at_least") + F.col("tokens") + longer * F.col("length")
    return summed.select("length", "n_docs", "docs_at_least", "tokens_at_least",
                         (F.col("all_docs") - longer).alias("docs_up_to"),
                         ((F.col("all_docs") - longer) / F.col("all_docs")).alias("share_up_to"),
                         kept.alias("truncated_total"))


def totals(lengths: DataFrame, limits: list[int]) -> DataFrame:
    """``limit, n_docs, n_tokens, longer_docs, truncated_total`` for each context limit, from the histogram."""
    if not limits:
        raise ValueError("name at least one limit")
    aggregates = [F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum(F.col("length") * F.col("n_docs")), F.lit(0)).alias("n_tokens")]
    for x in limits:
        aggregates += [F.coalesce(F.sum(F.when(F.col("length") > x, F.col("n_docs"))), F.lit(0)).alias(f"longer_{x}"),
                       F.coalesce(F.sum(F.least("length", F.lit(x)) * F.col("n_docs")), F.lit(0)).alias(f"kept_{x}")]
    answered = lengths.agg(*aggregates)
    each = F.explode(F.array(*[F.struct(F.lit(int(x)).cast("long").alias("limit"), F.col(f"longer_{x}").alias("longer_docs"), F.col(f"kept_{x}").alias("truncated_total")) for x in limits]))
    return answered.select("n_docs", "n_tokens", each.alias("at")).select("at.limit", "n_docs", "n_tokens", "at.longer_docs", "at.truncated_total")


def quantile(sums: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    return sums.filter(F.col("share_up_to") >= share).agg(F.min("length")).first()[0]
