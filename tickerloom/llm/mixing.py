"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words, runs of ``[^\\x20\\x09-\\x0D]``. Sources in code-point order,
NULL last, weigh 3, 1, 2, repeating. They share ``SHARE`` of all sizes by weight; a target stops at
``MOST`` times its source's size and the excess is reshared by weight, until none is above. Targets are
found in rounds of one aggregate over the sources each, in whole numbers.

Every document of a source is expected ``target / source_size`` times. Prefix sums of the expected
copies, plus one offset drawn per source, cross a whole number once per copy, so a document is taken as
often as its expectation rounded down or up. Documents stand in order of size up and down again, every
second one on the way up and the others on the way down: whatever the offset gives away on one side it gains
on the other, and a source's taken words miss its target by less than its largest document or so.
Expected copies are whole multiples of ``2^-24``, offsets come from a hash of the source: reruns agree.

A document's rank by size is found without gathering a source in one task: rows are dealt in ranges of the whole
order, numbered within their range, and moved on by the number of the source's rows in earlier ranges. The
sources themselves are numbered in the same way. A hot source or size is cut into as many ranges as it fills.

Only DataFrame functions are used.

Defined cases: NULL or blank text has size 0 and takes no words; a NULL source is a source; a source
without words has target 0 and no copies; a document is a row, repeated rows are dealt copies one by
one; documents of equal size stand in order of their id, NULL first, then of a hash of their text; an
empty table gives no rows; other columns, whatever their names, come through ``mixed`` as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging, stage

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # of all sizes: three halves
MOST = 2        # copies of a document, and times a source's size
UNIT = 1 << 24  # parts of a copy
_BLANK = r"\x20\x09-\x0D"


def words_in(text: Column) -> Column:
    """The number of words: each becomes one dot together with the blanks behind it."""
    begun = F.regexp_replace(text, f"^[{_BLANK}]+", "")
    dots = F.regexp_replace(begun, f"[^{_BLANK}]+[{_BLANK}]*", ".")
    return F.coalesce(F.char_length(dots), F.lit(0)).cast("long")


def placed(rows: DataFrame, group: list[str], order: list[Column], keep: Staging, name: str) -> DataFrame:
    """``rows`` with ``place``, from 0, within ``group`` in ``order``; a group may fill any number of tasks."""
    ranges = keep(rows.repartitionByRange(*[F.col(c).asc_nulls_last() for c in group], *order)
                  .withColumn("slice", F.spark_partition_id()), f"{name}-ranges")
    counts = ranges.groupBy("slice", *group).agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("slice").alias("__slice"), *[F.col(c).alias(f"__{c}") for c in group],
                           F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    same = F.col("slice") == F.col("__slice")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    number = F.row_number().over(Window.partitionBy("slice", *group).orderBy(*order))
    return (ranges.withColumn("number", number).join(before, same)
            .withColumn("place", F.col("before") + F.col("number") - 1)
            .drop("slice", "number", "before", *before.columns))


def targets(sizes: DataFrame, keep: Staging) -> DataFrame:
    """``(source, documents, source_size, target, step, offset)`` of rows ``(source, size)``; step and offset in units."""
    totals = keep(sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size")), "totals")
    ranked = placed(totals.withColumn("every", F.lit(0)), ["every"], [F.col("source").asc_nulls_last()], keep, "sources")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighed = keep(ranked.select("source", "documents", F.col("source_size").cast("decimal(20, 0)").alias("source_size"), weight.cast("long").alias("weight")), "weighed")
    whole = weighed.agg(F.sum("source_size")).first()[0] or 0
    # The level: what a unit of weight gets is left / (SHARE[1] * open). It rises until no open source is above its most.
    left, open_ = 0, 0
    while True:
        above = F.col("weight") * F.lit(left) > MOST * SHARE[1] * open_ * F.col("source_size") if open_ else F.lit(False)
        full, rest = weighed.agg(F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))).first()
        level = (SHARE[0] * int(whole) - MOST * SHARE[1] * int(full or 0), int(rest or 0))
        if level == (left, open_):
            break
        left, open_ = level
    size = F.col("source_size").cast("long")
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(SHARE[1] * max(open_, 1)).cast("double")
    target = F.when(above, (MOST * size).cast("double")).otherwise(share)
    step = F.when(size > 0, F.least(F.floor(target / size * UNIT), F.lit(MOST * UNIT))).otherwise(0)
    drawn = F.conv(F.substring(F.md5(F.coalesce("source", F.lit("")).cast("binary")), 1, 6), 16, 10)
    return weighed.select("source", "documents", size.alias("source_size"), target.alias("target"), step.cast("long").alias("step"), drawn.cast("long").alias("offset"))


def sampled(docs: DataFrame, columns: list[str], keep: Staging) -> DataFrame:
    """``columns`` of every row of ``docs``, named ``c0, c1, ...``, with ``size, source_size, target, copies, taken``."""
    row = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    sized = keep(docs.select(*row, F.col("source").cast("string").alias("source"), words_in(F.col("text")).alias("size"),
                             F.col("doc_id").alias("tie"), F.xxhash64("text").alias("text_hash")), "sizes")
    order = [F.col("size").asc(), F.col("tie").asc_nulls_first(), F.col("text_hash").asc()]
    levels = keep(targets(sized.select("source", "size"), keep), "targets").withColumnRenamed("source", "__source")
    counted = placed(sized, ["source"], order, keep, "rows").join(levels, F.col("source").eqNullSafe(F.col("__source")))
    half = F.shiftright("place", 1)
    place = F.when(F.col("place") % 2 == 0, half).otherwise(F.col("documents") - 1 - half)
    crossed = lambda place: F.shiftright(place * F.col("step") + F.col("offset"), UNIT.bit_length() - 1)
    copies = crossed(place + 1) - crossed(place)
    return counted.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def taken_words(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    with Staging(docs.sparkSession) as keep:
        rows = sampled(docs, ["doc_id"], keep)
        return stage(rows.select(F.col("c0").alias("doc_id"), "size", "source_size", "target", "taken"), "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken."""
    with Staging(docs.sparkSession) as keep:
        rows = sampled(docs, docs.columns, keep).filter("copies > 0")
        repeated = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        return stage(repeated.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]), "mixed")


ORACLE = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source),
cumulated AS (  -- sources by how soon they are full: their most over their weight
    SELECT *, 2 * source_size * (6 // weight) AS full_at,
           sum(source_size) OVER () AS whole,
           coalesce(sum(2 * source_size) OVER (ORDER BY source_size * (6 // weight), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
           sum(weight) OVER (ORDER BY source_size * (6 // weight), source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM ranked),
level AS (  -- the first place from where on all are open
    SELECT 3 * whole - 2 * full_before AS left_over, open_weight, full_at FROM cumulated
    WHERE full_at * 2 * open_weight >= 6 * (3 * whole - 2 * full_before)
    ORDER BY full_at, open_weight DESC LIMIT 1),
targets AS (
    SELECT source, source_size,
           CASE WHEN weight * left_over > 4 * l.open_weight * source_size THEN (2 * source_size)::DOUBLE
                ELSE (weight * left_over)::DOUBLE / (2 * l.open_weight)::DOUBLE END AS target
    FROM ranked, level l),
stepped AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size::DOUBLE * 16777216)::BIGINT, 33554432) ELSE 0 END AS step,
           ('0x' || substr(md5(coalesce(source, '')), 1, 6))::BIGINT AS start
    FROM targets),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS rank,
           count(*) OVER (PARTITION BY source) AS documents FROM sized),
placed AS (SELECT *, CASE WHEN rank % 2 = 0 THEN rank // 2 ELSE documents - 1 - rank // 2 END AS place FROM ordered)
SELECT p.doc_id, p.size, t.source_size, t.target,
       ((((place + 1) * step + start) >> 24) - ((place * step + start) >> 24)) * p.size AS taken
FROM placed p JOIN stepped t ON p.source IS NOT DISTINCT FROM t.source
"""
