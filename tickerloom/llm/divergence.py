"""How far apart the sources of a language are in their use of terms: a task per pair of sources.

A term is a run of ASCII letters and code points from 0x80 on, A-Z in lower case. A language keeps the
terms of at least ``min_docs`` of its documents. A term's price in a group of ``n`` kept occurrences is
``1 + floor(SCALE * (count + 2) / (n + 2 * V))``, whole numbers throughout; two prices differ by
``floor((p - q)^2 / (p + q))``, which is the same both ways.

Every (language, source) is held as sorted arrays of (term id, count). Terms are numbered in blocks of
about ``BLOCK`` by a hash of the term, so an array is bounded however large the vocabulary grows. The
arrays of both sources of an unordered pair are co-grouped block by block; a galloping intersection
finds the terms both have, the others are priced against the other side's price of a term it lacks,
and terms that neither has are counted and priced once. So no dense vector is made, and a hot source
costs no more than its distinct terms.

Counting is done per task and flushed at ``HELD`` entries, then per term in Spark: a term or source that
a third of all rows share costs one row per flush. The pairs of a language's sources are the result
itself; they are dealt by ``SPREAD`` salts, each source's arrays travel once per other source.

Defined cases: NULL text, language and source count as ''; every row is a document, repeated ones too;
a document without terms still makes its group occur; a language that keeps no term has pairs of
value 0 and no terms; a language with one source has no pairs; ties go to the smaller item in UTF-8
order; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging, stage
from .text import map_arrow, slices

SCALE = 1_000_000_000
BLOCK = 1 << 14
HELD = 1 << 18
SPREAD = 16
STRIDE = 64
_PAIR = ["lang", "a", "b"]


def _letters() -> bytes:
    """Separators become blanks, A-Z lower case; bytes from 0x80 on belong to letters."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    table[97:123] = table[65:91] = bytes(range(97, 123))
    return bytes(table)


_LETTERS = _letters()


def _flushed(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        terms = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64()),
             pa.array([docs[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for batch in slices(batches, "text"):
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for text, lang, source in zip(batch.column("text"), langs, sources):
            terms = text.as_buffer().to_pybytes().translate(_LETTERS).split()
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            counts.update(terms)
            docs.update(set(terms))
        if sum(len(counts) for counts, _ in held.values()) >= HELD:
            yield from _flushed(held)
            held = {}
    yield from _flushed(held)


def group_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of every term in every group."""
    counted = map_arrow(docs.select("text", "lang", "source"), _count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where each value of sorted ``short`` stands, or would stand, in sorted ``long``.

    ``STRIDE`` values at a time: steps that double find the end of the stretch that can hold them, a
    binary search places them in it.
    """
    places = np.empty(len(short), np.int64)
    at = 0
    for first in range(0, len(short), STRIDE):
        some = short[first:first + STRIDE]
        step = STRIDE
        while at + step < len(long) and long[at + step] < some[-1]:
            step *= 2
        places[first:first + STRIDE] = at + np.searchsorted(long[at:at + step + 1], some)
        at = int(places[first + len(some) - 1])
    return places


def prices(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """Exact prices: the scale is multiplied in three steps, so that nothing exceeds 64 bits."""
    left, below = counts + 2, total + 2 * terms
    price = np.zeros(len(counts), np.int64)
    for _ in range(3):
        left = left * 1000
        price = price * 1000 + left // below
        left = left % below
    return price + 1


def _gap(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // (p + q)).sum())


def _side(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    if not rows.num_rows:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return rows.column("ids")[0].values.to_numpy(), rows.column("counts")[0].values.to_numpy()


def _merge(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """The terms of one block that either source of a pair has: how many, and their priced differences."""
    some = left if left.num_rows else right
    n_a, n_b, terms = (some.column(c)[0].as_py() for c in ("n_a", "n_b", "v"))
    (ids_a, counts_a), (ids_b, counts_b) = _side(left), _side(right)
    p, q = prices(counts_a, n_a, terms), prices(counts_b, n_b, terms)
    p_none, q_none = prices(np.zeros(1, np.int64), n_a, terms), prices(np.zeros(1, np.int64), n_b, terms)
    if len(ids_a) <= len(ids_b):
        at = gallop(ids_a, ids_b)
        here = np.flatnonzero((at < len(ids_b)) & (ids_b[np.minimum(at, len(ids_b) - 1)] == ids_a)) if len(ids_b) else at
        both_a, both_b = here, at[here]
    else:
        at = gallop(ids_b, ids_a)
        here = np.flatnonzero((at < len(ids_a)) & (ids_a[np.minimum(at, len(ids_a) - 1)] == ids_b))
        both_a, both_b = at[here], here
    value = _gap(p[both_a], q[both_b]) + _gap(np.delete(p, both_a), q_none) + _gap(p_none, np.delete(q, both_b))
    lang, a, b = (k.as_py() for k in key[:3])
    return pa.table({"lang": [lang], "a": [a], "b": [b], "covered": [len(p) + len(q) - len(both_a)], "value": [value]},
                    schema=pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("covered", pa.int64()), ("value", pa.int64())]))


def price_of(count: Column | str, total: str, terms: str) -> Column:
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10, 0)) * ({count} + 2)) DIV ({total} + 2 * {terms})")


def gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def source_pairs(groups: DataFrame) -> DataFrame:
    """Every unordered pair of sources of a language with what prices it: ``lang, a, b, n_a, n_b, v``."""
    left = groups.select("lang", F.col("source").alias("a"), F.col("group_n").alias("n_a"), "v",
                         F.pmod(F.xxhash64("source"), F.lit(SPREAD)).alias("salt"))
    right = groups.select("lang", F.col("source").alias("b"), F.col("group_n").alias("n_b"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias("salt"))
    return left.join(right, ["lang", "salt"]).filter("a < b").select(*_PAIR, "n_a", "n_b", "v")


def divergence(docs: DataFrame, min_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: for every group the other sources of its language by
    distance (part ``pair``) and the terms it uses most above the language (part ``term``)."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    with Staging(docs.sparkSession) as keep:
        counted = keep(group_terms(named), "counted")
        kept = keep(counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
                    .filter(F.col("docs") >= min_docs).drop("docs"), "kept")
        langs = keep(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n")), "langs")
        blocked = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / BLOCK)))
        # Dealt by block in any case: the rows of a language joined by language would otherwise stay together.
        blocked = blocked.repartition("lang", "block")
        number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
        terms = keep(blocked.withColumn("id", number), "terms")
        held = keep(counted.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "held")
        groups = keep(
            named.select("lang", "source").distinct()
            .join(held.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left")
            .join(langs.select("lang", "v"), "lang", "left").fillna(0, ["group_n", "v"]), "groups")

        cells = F.sort_array(F.collect_list(F.struct("id", "n")))
        arrays = keep(held.groupBy("lang", "source", "block").agg(cells.alias("cells"))
                      .select("lang", "source", "block", F.col("cells.id").alias("ids"), F.col("cells.n").alias("counts")), "arrays")
        pairs = keep(source_pairs(groups), "pairs")
        task = [*_PAIR, "block"]
        one = pairs.join(arrays.withColumnRenamed("source", "a"), ["lang", "a"]).groupBy(*task)
        two = pairs.join(arrays.withColumnRenamed("source", "b"), ["lang", "b"])
        two = two.toDF(*two.columns).groupBy(*task)  # columns of its own beside those of the other side
        merged = one.cogroup(two).applyInArrow(_merge, "lang string, a string, b string, covered long, value long")
        summed = merged.groupBy(*_PAIR).agg(F.sum("covered").alias("covered"), F.sum("value").alias("value"))
        absent = F.when(F.col("v") > 0, (F.col("v") - F.coalesce("covered", F.lit(0))) * gap("p", "q")).otherwise(0)
        apart = (pairs.join(summed, _PAIR, "left")
                 .withColumns({"p": F.when(F.col("v") > 0, price_of("0L", "n_a", "v")), "q": F.when(F.col("v") > 0, price_of("0L", "n_b", "v"))})
                 .select("lang", (F.coalesce("value", F.lit(0)) + absent).alias("value"),
                         F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                           F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way"))
                 .select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value"))
        far = (held.join(groups.select("lang", "source", "group_n"), ["lang", "source"])
               .withColumns({"p": price_of("n", "group_n", "v"), "q": price_of("total", "lang_n", "v")})
               .filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap("p", "q").alias("value")))
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        ranked = apart.withColumn("rank", rank).union(far.withColumn("rank", rank).filter(F.col("rank") <= top_terms))
        return stage(ranked, "divergence")


_PRICE = "1 + ({scale}::HUGEINT * ({n} + 2)) // ({total} + 2 * v)"
ORACLE = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents),
terms AS (
    SELECT row, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT row, lang, source, unnest(regexp_extract_all(text, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS raw FROM docs)),
kept AS (SELECT lang, term, count(*) AS total FROM terms GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms GROUP BY lang, source, term),
grid AS (
    SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n, l.v, l.lang_n,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS group_n
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
priced AS (
    SELECT lang, source, term, n, {_PRICE.format(scale=SCALE, n="n", total="group_n")} AS p,
           {_PRICE.format(scale=SCALE, n="total", total="lang_n")} AS q
    FROM grid),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM priced WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
